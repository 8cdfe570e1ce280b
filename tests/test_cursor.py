import datetime as dt

from millrace import schemas, storage
from millrace.cursor import StoredCursor, last_report, report_change, report_new_files

UTC = dt.timezone.utc


def listing(spark, *paths):
    return spark.createDataFrame([(path,) for path in paths], "file_path string")


def paths(frame):
    return sorted(row["file_path"] for row in frame.collect())


def test_each_file_is_reported_once(spark, tmp_path):
    root = str(tmp_path / "cursor")
    assert paths(report_new_files(spark, listing(spark, "a", "b", "b"), root)) == ["a", "b"]
    assert paths(report_new_files(spark, listing(spark, "a", "b"), root)) == []
    assert paths(report_new_files(spark, listing(spark, "b", "c"), root)) == ["c"]
    assert paths(last_report(spark, root)) == ["c"]
    assert paths(report_new_files(spark, listing(spark), root)) == []
    assert paths(report_new_files(spark, listing(spark, "b"), root)) == ["b"]  # it was gone


def test_a_version_is_replaced_only_by_one_of_those_that_read_it(spark, tmp_path):
    rows = lambda *values: spark.createDataFrame([(v, True) for v in values], schemas.SEEN_FILES)
    ours, theirs = (StoredCursor(spark, str(tmp_path / "c"), schemas.SEEN_FILES) for _ in range(2))
    read = ours.version()
    assert read == 0 and ours.read(0).isEmpty()
    assert theirs.replace(rows("t"), read) == 1
    assert ours.replace(rows("o"), read) is None
    assert paths(ours.read(ours.version())) == ["t"]
    assert len(storage.subdirectories(spark, f"{ours.root}/data")) == 1


def test_a_run_that_slept_for_many_versions_loses(spark, tmp_path):
    cursor = StoredCursor(spark, str(tmp_path / "c"), schemas.SEEN_FILES)
    rows = spark.createDataFrame([("x", True)], schemas.SEEN_FILES)
    for version in range(6):
        assert cursor.replace(rows, version) == version + 1
    assert storage.file_names(spark, f"{cursor.root}/marks") == ["4", "5", "6"]
    assert cursor.replace(rows, 0) is None  # the mark of version 1 is free again
    assert cursor.version() == 6 and not cursor.read(6).isEmpty()
    assert len(storage.subdirectories(spark, f"{cursor.root}/data")) == 3


def test_two_observers_share_the_report(spark, tmp_path, monkeypatch):
    """The other run replaces the version between our reading and our writing."""
    root, original, others = str(tmp_path / "c"), StoredCursor.replace, []

    def interrupted(self, rows, read):
        if not others:
            others.append(None)
            others[0] = paths(report_new_files(spark, listing(spark, "a"), root))
        return original(self, rows, read)

    monkeypatch.setattr(StoredCursor, "replace", interrupted)
    assert paths(report_new_files(spark, listing(spark, "a", "b"), root)) == ["b"]
    assert others == [["a"]]


def test_a_change_is_reported_once(spark, tmp_path):
    root = str(tmp_path / "c")

    def observed(*hours):
        instants = [(dt.datetime(2025, 1, 1, hour, tzinfo=UTC),) for hour in hours]
        table = spark.createDataFrame(instants, "fetched_at timestamp")
        return [row["row_count"] for row in report_change(spark, table, root).collect()]

    assert observed() == []
    assert observed(1) == [1]
    assert observed(1) == []
    assert observed(1, 2) == [2]
    assert observed() == []
    assert observed(1, 2) == []
