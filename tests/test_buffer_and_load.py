import datetime as dt
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace import schemas, storage
from millrace.operators import files
from millrace.plans import load
from millrace.sinks import buffer as sink
from millrace.sinks import tables
from millrace.sources import buffer

UTC = dt.timezone.utc
NOW = dt.datetime(2025, 3, 10, 12, tzinfo=UTC)


def events(spark, *rows, **changes):
    """Rows of (event_id, time); every other column is filled in."""
    full = []
    for event_id, when in rows:
        at = dt.datetime.fromisoformat(when).replace(tzinfo=UTC)
        values = dict.fromkeys(schemas.RAW_NRT.names) | {
            "event_id": event_id, "event_dt": at, "wiki": "w", "type": "edit", "bot": False,
            "raw_json": "{}",
        } | changes
        full.append(tuple(values[name] for name in schemas.RAW_NRT.names))
    return spark.createDataFrame(full, schemas.RAW_NRT)


def land(spark, root, *rows, **changes):
    flat = events(spark, *rows, **changes)
    sink.write_buffer(flat.withColumn("dt", F.date_format("event_dt", "yyyy-MM-dd")), root)


def data_files(root):
    return sorted(
        os.path.relpath(os.path.join(folder, name), root)
        for folder, _, names in os.walk(root)
        for name in names
        if name.endswith(".parquet")
    )


@pytest.fixture
def roots(tmp_path):
    return tuple(str(tmp_path / name) for name in ("buffer", "raw", "manifest"))


def test_one_file_per_date_whatever_the_wikis(spark, roots):
    rows = events(spark, ("a", "2025-03-09 01:00:00"), ("b", "2025-03-09 23:59:59"), ("c", "2025-03-10 00:00:00"))
    mixed = rows.withColumn("wiki", F.col("event_id")).withColumn("dt", F.date_format("event_dt", "yyyy-MM-dd"))
    sink.write_buffer(mixed.repartition(4), roots[0])
    assert [os.path.dirname(f) for f in data_files(roots[0])] == ["dt=2025-03-09", "dt=2025-03-10"]


def test_a_large_date_is_cut_into_several_files(spark, roots):
    wide = spark.range(200_000).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit(NOW).cast("timestamp").alias("event_dt"),
        F.lit("w").alias("wiki"),
        F.sha2(F.col("id").cast("string"), 512).alias("raw_json"),
    )
    rows = wide.select(
        *[F.col(n) if n in wide.columns else F.lit(None).cast(schemas.RAW_NRT[n].dataType).alias(n)
          for n in schemas.RAW_NRT.names],
        F.lit("2025-03-10").alias("dt"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        sink.write_buffer(rows, roots[0])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(data_files(roots[0])) > 1
    assert buffer.scan_since(spark, roots[0]).count() == 200_000


def test_writes_add_files_and_leave_others_alone(spark, roots):
    land(spark, roots[0], ("a", "2025-03-09 01:00:00"))
    before = data_files(roots[0])
    land(spark, roots[0], ("b", "2025-03-09 02:00:00"))
    assert set(before) < set(data_files(roots[0]))


def test_scan_since(spark, roots, tmp_path):
    land(spark, roots[0], ("old", "2025-03-01 00:00:00"), ("edge", "2025-03-08 00:00:00"), ("new", "2025-03-09 00:00:00"))
    for odd in ("dt=not-a-date", "dt=2025", "dt=2025-3-9", "other", "dt=2025-03-09/deeper"):
        land(spark, str(tmp_path / "odd"), (odd, "2025-03-09 00:00:00"))
        os.makedirs(f"{roots[0]}/{odd}")
        [name] = data_files(str(tmp_path / "odd"))
        os.rename(f"{tmp_path}/odd/{name}", f"{roots[0]}/{odd}/x.parquet")
    ids = lambda since: {r[0] for r in buffer.scan_since(spark, roots[0], since).select("event_id").collect()}
    assert ids(dt.date(2025, 3, 8)) == {"edge", "new", "dt=2025-03-09/deeper"}
    assert ids(None) == {"old", "edge", "new", "dt=not-a-date", "dt=2025", "dt=2025-3-9", "other", "dt=2025-03-09/deeper"}
    listed = buffer.file_inventory(spark, roots[0], dt.date(2025, 3, 8))
    assert listed.count() == 3 and listed.where("bytes <= 0 or modified_at is null").isEmpty()


def test_missing_root_has_no_files(spark, tmp_path):
    for since in (None, dt.date(2025, 1, 1)):
        assert buffer.scan_since(spark, str(tmp_path / "none"), since).count() == 0
        assert buffer.file_inventory(spark, str(tmp_path / "none"), since).count() == 0


def test_dead_letters(spark, tmp_path):
    bad = spark.createDataFrame([("why", '{"a": 1')], "error string, raw_line string")
    sink.write_dead_letters(bad, str(tmp_path / "q"), NOW)
    [path] = list((tmp_path / "q" / "dt=2025-03-10").glob("*.json"))
    assert json.loads(path.read_text()) == {
        "received_at": "2025-03-10T12:00:00+00:00", "error": "why", "raw_line": '{"a": 1',
    }


def test_load_takes_each_file_once(spark, roots):
    land(spark, roots[0], ("a", "2025-03-09 01:00:00.123456"), ("b", "2025-03-09 02:00:00"))
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(1, 2)
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(0, 0)
    land(spark, roots[0], ("c", "2025-03-10 01:00:00"))
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(1, 1)
    raw = load.read_raw_nrt(spark, roots[1])
    assert {r["event_id"]: r["dt"] for r in raw.collect()} == {"a": "2025-03-09", "b": "2025-03-09", "c": "2025-03-10"}
    millis = raw.where("event_id = 'a'").select(F.unix_micros("event_dt") % 1_000_000).first()[0]
    assert millis == 123_000
    recorded = load.read_manifest(spark, roots[2])
    assert sorted(r["row_count"] for r in recorded.collect()) == [1, 2]
    assert recorded.where(F.col("loaded_at") != F.lit(NOW)).isEmpty()


def test_raw_files_are_ordered_for_data_skipping(spark, roots):
    rows = events(spark, *[(f"e{i}", f"2025-03-09 {i % 24:02}:00:00") for i in range(60)])
    mixed = rows.withColumn("wiki", F.concat(F.lit("w"), F.crc32("event_id") % 4))
    tables.append_raw_nrt(mixed.repartition(3), roots[1])
    [path] = data_files(roots[1])
    stored = pq.read_table(f"{roots[1]}/{path}", columns=schemas.RAW_NRT_SORT).to_pylist()
    keys = [tuple(row.values()) for row in stored]
    assert len(keys) == 60 and keys == sorted(keys)


def test_nothing_to_load(spark, roots):
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(0, 0)


def test_files_are_loaded_in_bounded_jobs(spark, roots):
    for n in range(5):
        land(spark, roots[0], (f"{n}-a", "2025-03-09 01:00:00"), (f"{n}-b", "2025-03-09 02:00:00"))
    assert load.load_new_files(spark, *roots, NOW, files_per_job=2) == load.LoadResult(5, 10)
    assert len(data_files(roots[1])) == 3
    assert load.read_manifest(spark, roots[2]).count() == 5


def test_since_leaves_older_partitions_unseen(spark, roots):
    land(spark, roots[0], ("old", "2025-03-01 00:00:00"))
    land(spark, roots[0], ("new", "2025-03-09 00:00:00"))
    assert load.load_new_files(spark, *roots, NOW, since=dt.date(2025, 3, 8)).files_loaded == 1
    assert [r["event_id"] for r in load.read_raw_nrt(spark, roots[1]).collect()] == ["new"]


def test_a_file_loaded_long_ago_is_not_loaded_again(spark, roots):
    """The manifest is matched by path, not by the time of loading."""
    land(spark, roots[0], ("ahead", "2025-03-20 00:00:00"))
    load.load_new_files(spark, *roots, NOW - dt.timedelta(days=9))
    assert load.load_new_files(spark, *roots, NOW, since=dt.date(2025, 3, 9)).files_loaded == 0


def test_a_file_without_rows_is_recorded(spark, roots):
    os.makedirs(f"{roots[0]}/dt=2025-03-09")
    events(spark).coalesce(1).write.parquet(f"{roots[0]}/dt=2025-03-09/empty")
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(1, 0)
    assert load.load_new_files(spark, *roots, NOW).files_loaded == 0


@pytest.mark.parametrize("name", schemas.RAW_NRT.names)
def test_a_file_without_one_of_the_columns_is_not_loaded(spark, roots, name):
    land(spark, roots[0], ("b", "2025-03-08 00:00:00"))
    folder = f"{roots[0]}/dt=2025-03-09"
    events(spark, ("a", "2025-03-09 00:00:00")).drop(name).coalesce(1).write.parquet(folder)
    with pytest.raises(Exception, match=f"no {name} in .*dt=2025-03-09/part-"):
        load.load_new_files(spark, *roots, NOW)
    assert load.read_manifest(spark, roots[2]).count() == 0


def test_a_file_with_real_nulls_is_loaded(spark, roots):
    land(spark, roots[0], ("a", "2025-03-09 00:00:00"))
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(1, 1)
    [row] = load.read_raw_nrt(spark, roots[1]).collect()
    assert row["user"] is None and row["namespace"] is None and row["length_new"] is None


def test_the_smallest_integer_is_a_value_like_any_other(spark, roots):
    land(spark, roots[0], ("a", "2025-03-09 00:00:00"), namespace=-(2**63), length_old=-(2**62))
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(1, 1)
    [row] = load.read_raw_nrt(spark, roots[1]).collect()
    assert (row["namespace"], row["length_old"]) == (-(2**63), -(2**62))


def test_listing_tasks_do_not_follow_the_bytes(spark, roots):
    for day in range(1, 20):
        land(spark, roots[0], ("a", f"2025-03-{day:02d} 00:00:00"))
    whole = buffer.file_inventory(spark, roots[0])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        cut = buffer.file_inventory(spark, roots[0])
        assert cut.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        assert cut.count() == whole.count() == 19
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_small_batch_leaves_one_quarantine_file(spark, tmp_path):
    root = str(tmp_path / "bad")
    letters = spark.range(64).repartition(64).selectExpr("'e' AS error", "cast(id AS string) AS raw_line")
    sink.write_dead_letters(letters, root, NOW)
    assert len([n for _, _, names in os.walk(root) for n in names if n.endswith(".json")]) == 1
    assert spark.read.json(root).count() == 64


def test_directories_go_whole_only_when_all_their_files_go(spark, roots):
    land(spark, roots[0], ("a", "2025-03-08 00:00:00"), ("b", "2025-03-09 00:00:00"))
    load.load_new_files(spark, *roots, NOW)
    land(spark, roots[0], ("c", "2025-03-09 00:00:00"))
    later = dt.datetime.now(UTC) + dt.timedelta(days=2)
    assert load.delete_loaded_files(spark, roots[0], roots[2], later) == 2
    assert not os.path.exists(f"{roots[0]}/dt=2025-03-08")
    assert [r["event_id"] for r in buffer.scan_since(spark, roots[0]).collect()] == ["c"]


@pytest.mark.parametrize("dies_in", ["append_raw_nrt", "file_row_counts", "append_manifest"])
def test_a_load_that_died_is_repeated_without_trace(spark, roots, monkeypatch, dies_in):
    land(spark, roots[0], ("a", "2025-03-09 00:00:00"), ("b", "2025-03-08 00:00:00"))
    with monkeypatch.context() as patched:
        patched.setattr(load, dies_in, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load.load_new_files(spark, *roots, NOW)
    # A file that has come since is a load of its own.
    land(spark, roots[0], ("c", "2025-03-09 01:00:00"))
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(3, 3)
    assert sorted(r["event_id"] for r in load.read_raw_nrt(spark, roots[1]).collect()) == ["a", "b", "c"]
    assert load.read_manifest(spark, roots[2]).count() == 3
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(0, 0)
    assert list(load.planned_loads(spark, roots[2]).unfinished()) == []


def test_half_a_manifest_is_completed(spark, roots, monkeypatch):
    land(spark, roots[0], ("a", "2025-03-09 00:00:00"), ("b", "2025-03-08 00:00:00"))
    append = load.append_manifest

    def half(rows, root):
        append(rows.where("file_path LIKE '%dt=2025-03-08%'"), root)
        raise OSError

    with monkeypatch.context() as patched:
        patched.setattr(load, "append_manifest", half)
        with pytest.raises(OSError):
            load.load_new_files(spark, *roots, NOW)
    later = dt.datetime.now(UTC) + dt.timedelta(days=2)
    assert load.delete_loaded_files(spark, roots[0], roots[2], later) == 0  # still to be read again
    load.load_new_files(spark, *roots, NOW)
    assert load.read_raw_nrt(spark, roots[1]).count() == 2
    assert load.read_manifest(spark, roots[2]).count() == 2
    assert load.delete_loaded_files(spark, roots[0], roots[2], later) == 2


def test_a_plan_that_was_not_written_is_forgotten(spark, roots):
    land(spark, roots[0], ("a", "2025-03-09 00:00:00"))
    planned = load.planned_loads(spark, roots[2])
    os.makedirs(f"{planned.root}/load-torn")
    assert load.load_new_files(spark, *roots, NOW) == load.LoadResult(1, 1)
    assert not os.path.exists(f"{planned.root}/load-torn")


def test_the_same_files_are_the_same_load():
    assert load.load_id_of(["b", "a"]) == load.load_id_of(iter(["a", "b"])) != load.load_id_of(["a"])


def test_deliveries_of_closed_days_stay_out_of_the_raw_table(spark, roots, tmp_path):
    expired, horizon = str(tmp_path / "expired"), dt.datetime(2025, 3, 9, tzinfo=UTC)
    land(spark, roots[0], ("old", "2025-03-08 23:59:59"), ("new", "2025-03-09 00:00:00"))
    result = load.load_new_files(spark, *roots, NOW, horizon=horizon, expired_root=expired)
    assert result == load.LoadResult(2, 2)
    assert [r["event_id"] for r in load.read_raw_nrt(spark, roots[1]).collect()] == ["new"]
    assert [r["event_id"] for r in load.read_raw_nrt(spark, expired).collect()] == ["old"]


def test_cleanup_needs_both_age_and_a_manifest_row(spark, roots):
    land(spark, roots[0], ("loaded", "2025-03-09 00:00:00"))
    load.load_new_files(spark, *roots, NOW)
    land(spark, roots[0], ("waiting", "2025-03-09 00:00:00"))
    soon, later = (dt.datetime.now(UTC) + dt.timedelta(days=d) for d in (0, 2))
    assert load.delete_loaded_files(spark, roots[0], roots[2], soon) == 0
    assert load.delete_loaded_files(spark, roots[0], roots[2], later) == 1
    assert [r["event_id"] for r in buffer.scan_since(spark, roots[0]).collect()] == ["waiting"]


def test_cleanup_age_is_inclusive(spark):
    listed = spark.createDataFrame(
        [("a", NOW - dt.timedelta(days=1)), ("b", NOW - dt.timedelta(hours=23, minutes=59))],
        "file_path string, modified_at timestamp",
    )
    assert [r[0] for r in files.cleanup_candidates(listed, listed, NOW).select("file_path").collect()] == ["a"]


def test_observed_files(spark):
    frame = lambda *paths: spark.createDataFrame([(p,) for p in paths], "file_path string")
    rows = files.observed_files(frame("a", "b", "c"), frame("b", "gone")).collect()
    assert {tuple(r) for r in rows} == {("a", True), ("b", False), ("c", True)}
    plan = files.observed_files(frame("a"), frame("b"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2


def test_paths_have_one_spelling(spark):
    frame = spark.createDataFrame([("file:///a/b",), ("file:/a/b",), ("hdfs://n/a",)], "p string")
    got = [r[0] for r in frame.select(storage.same_path(F.col("p"))).collect()]
    assert got == ["file:/a/b", "file:/a/b", "hdfs://n/a"]


def test_raw_batch_append(spark, tmp_path):
    root = str(tmp_path / "batch")
    articles = spark.createDataFrame(
        [("p", "x", "A", 9, 1, dt.date(2025, 3, 9)), ("p", "x", "B", 5, 2, dt.date(2025, 2, 9))],
        "project string, access string, article string, views bigint, rank bigint, date date",
    )
    assert tables.append_raw_batch(articles, root, NOW) == 2
    assert tables.append_raw_batch(articles.limit(0), root, NOW) == 0
    stored = storage.read_table(spark, root, schemas.RAW_BATCH, "month")
    assert stored.columns == [*schemas.RAW_BATCH.names, "month"]
    assert {(r["article"], r["month"]) for r in stored.collect()} == {("A", "202503"), ("B", "202502")}
    assert stored.where(F.col("fetched_at") != F.lit(NOW)).isEmpty()
