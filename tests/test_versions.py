import datetime as dt

from pyspark.sql import types as T

from millrace.horizon import advance_horizon, first_kept_day, read_horizon
from millrace.versions import VersionedTable

UTC = dt.timezone.utc
SCHEMA = T.StructType([T.StructField("n", T.LongType())])


def rows(spark, *pairs):
    return spark.createDataFrame(pairs, "n bigint, p string")


def content(frame):
    return sorted((r["p"], r["n"]) for r in frame.collect())


def test_readers_see_committed_versions_only(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), SCHEMA, "p")
    assert table.committed() is None and content(table.read()) == []
    table.write(rows(spark, (1, "a"), (2, "b")), 0, ["a", "b"])
    assert content(table.read()) == []
    table.commit(0)
    table.write(rows(spark, (3, "a")), 1, ["a"])
    assert content(table.read()) == [("a", 1), ("b", 2)]
    assert content(table.read(before=2)) == [("a", 3), ("b", 2)]
    table.commit(1)
    assert content(table.read()) == [("a", 3), ("b", 2)]
    assert content(table.read(values=["b"])) == [("b", 2)] and content(table.read(values=["z"])) == []


def test_a_version_written_again_replaces_itself(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), SCHEMA, "p")
    for _ in range(2):
        table.write(rows(spark, (1, "a")), 0, ["a"])
    table.commit(0)
    assert content(table.read()) == [("a", 1)] and content(table.read(before=0)) == []


def test_a_partition_left_without_rows_is_empty(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), SCHEMA, "p")
    table.write(rows(spark, (1, "a"), (2, "b")), 0, ["a", "b"])
    table.write(rows(spark), 1, ["a"])
    table.commit(1)
    assert content(table.read()) == [("b", 2)] and content(table.read(before=1)) == [("a", 1), ("b", 2)]


def test_what_a_version_needs_is_kept(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), SCHEMA, "p")
    for version in range(4):
        table.write(rows(spark, (version, "a")), version, ["a"])
        table.commit(version)
    table.forget(3)
    assert content(table.read(before=3)) == [("a", 2)] and content(table.read()) == [("a", 3)]
    assert content(table.read(before=2)) == []
    assert table.drop_partitions("b") == ["a"] and content(table.read()) == []


def test_the_horizon_never_moves_back(spark, tmp_path):
    root = str(tmp_path / "h")
    assert read_horizon(spark, None) is None and read_horizon(spark, root) is None
    assert advance_horizon(spark, root, dt.date(2025, 3, 5)) == dt.datetime(2025, 3, 5, tzinfo=UTC)
    assert advance_horizon(spark, root, dt.date(2025, 3, 4)) == dt.datetime(2025, 3, 5, tzinfo=UTC)
    assert read_horizon(spark, root) == dt.datetime(2025, 3, 5, tzinfo=UTC)


def test_first_kept_day_is_what_retention_keeps():
    midnight = dt.datetime(2025, 3, 10, tzinfo=UTC)
    assert first_kept_day(midnight, 5) == dt.date(2025, 3, 6)
    assert first_kept_day(midnight - dt.timedelta(seconds=1), 5) == dt.date(2025, 3, 5)
