import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace import queries, schemas
from millrace.horizon import advance_horizon, first_kept_day
from millrace.operators import deliveries, offsets, retention
from millrace.plans import load, marts
from millrace.sinks.buffer import read_flushes
from millrace.sources import buffer
from millrace.streaming import incremental, landing

UTC = dt.timezone.utc
NOW = dt.datetime(2025, 3, 10, 12, tzinfo=UTC)


def payload(event_id, when="2025-03-10T01:00:00Z", **changes):
    event = {"meta": {"id": event_id, "dt": when}, "type": "edit", "wiki": "w", "user": "u", **changes}
    return json.dumps(event).encode()


def publish(spark, root, *values):
    rows = [(None, bytearray(v), "t", 0, i, NOW) for i, v in enumerate(values)]
    spark.createDataFrame(rows, schemas.TOPIC_RECORD).coalesce(1).write.mode("append").parquet(root)


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_landing_splits_and_restarts(spark, tmp_path):
    source, out, bad, state = (str(tmp_path / n) for n in ("topic", "buffer", "bad", "state"))
    land = lambda: run(
        landing.landing_stream(
            spark.readStream.schema(schemas.TOPIC_RECORD).parquet(source), out, bad, state, lambda: NOW
        )
    )
    publish(spark, source, payload("a"), b"{cut", payload("b", type=5))
    land()
    land()
    publish(spark, source, payload("c", "2025-03-11T00:00:00Z"))
    land()
    rows = buffer.scan_since(spark, out)
    assert {(r["event_id"], r["dt"]) for r in rows.collect()} == {("a", "2025-03-10"), ("c", "2025-03-11")}
    letters = spark.read.schema(schemas.DEAD_LETTER).json(bad).collect()
    assert {r["raw_line"] for r in letters} == {"{cut", payload("b", type=5).decode()}
    assert {r["received_at"] for r in letters} == {"2025-03-10T12:00:00+00:00"}


def test_a_batch_of_rejects_only_is_done_with(spark, tmp_path):
    source, out, bad, state = (str(tmp_path / n) for n in ("topic", "buffer", "bad", "state"))
    publish(spark, source, b"x", b"y")
    for _ in range(2):
        records = spark.readStream.schema(schemas.TOPIC_RECORD).parquet(source)
        run(landing.landing_stream(records, out, bad, state, lambda: NOW))
    assert buffer.scan_since(spark, out).count() == 0
    assert spark.read.schema(schemas.DEAD_LETTER).json(bad).count() == 2


def test_batch_landing_and_the_way_to_the_mart(spark, tmp_path):
    names = ("topic", "buffer", "bad", "raw", "manifest")
    source, landed, bad, raw, manifest = (str(tmp_path / n) for n in names)
    publish(spark, source, payload("a"), payload("a"), payload("b", bot=True), b"{")
    landing.land(spark.read.parquet(source), landed, bad, NOW)
    load.load_new_files(spark, landed, raw, manifest, NOW)
    [row] = marts.edits_hourly(load.read_raw_nrt(spark, raw)).collect()
    assert (row["wiki"], row["edit_count"], row["bot_edit_count"], row["distinct_editors"]) == ("w", 2, 1, 1)


def write_events(spark, root, *rows):
    columns = [
        (i, dt.datetime.fromisoformat(t).replace(tzinfo=UTC), "w", "edit", None, None, u, False)
        + (None,) * 5 + ("{}",)
        for i, t, u in rows
    ]
    spark.createDataFrame(columns, schemas.RAW_NRT).coalesce(1).write.mode("append").parquet(root)


def test_load_stream_takes_each_file_once(spark, tmp_path):
    source, raw, state = (str(tmp_path / n) for n in ("buffer", "raw", "state"))
    for n in range(2):
        write_events(spark, f"{source}/dt=2025-03-10", (f"e{n}", "2025-03-10 01:00:00", "u"))
        for _ in range(2):
            run(incremental.load_stream(incremental.buffer_stream(spark, source), raw, state))
    assert sorted(r["event_id"] for r in load.read_raw_nrt(spark, raw).collect()) == ["e0", "e1"]


def test_mart_of_the_stream_is_that_of_all_deliveries(spark, tmp_path):
    source, raw, mart, state = (str(tmp_path / n) for n in ("buffer", "raw", "mart", "state"))
    drops = [
        [("a", "2025-03-10 09:00:00", "u"), ("b", "2025-03-10 01:00:00", "u"), ("c", "2025-03-10 01:10:00", "v")],
        [("a", "2025-03-10 15:00:00", "u"), ("d", "2025-03-10 01:30:00", "w")],
        [("b", "2025-03-10 00:30:00", "u"), ("e", "2025-03-10 09:00:00", "u"), ("d", "2025-03-10 01:30:00", "w")],
    ]
    for drop in drops:
        write_events(spark, f"{source}/dt=2025-03-10", *drop)
        run(incremental.mart_stream(spark, incremental.buffer_stream(spark, source), raw, mart, state))
        got = marts.read_edits_hourly(spark, mart).drop("dt").collect()
        want = marts.edits_hourly(load.read_raw_nrt(spark, raw)).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert {r["hour_ts"].hour for r in got} == {1, 9, 15}


def test_a_batch_reads_no_raw_rows(spark, tmp_path, monkeypatch):
    source, raw, mart, state = (str(tmp_path / n) for n in ("buffer", "raw", "mart", "state"))
    stream = lambda: run(incremental.mart_stream(spark, incremental.buffer_stream(spark, source), raw, mart, state))
    write_events(spark, f"{source}/dt=2025-03-10", ("a", "2025-03-10 01:00:00", "u"), ("b", "2025-03-10 02:00:00", "u"))
    stream()
    monkeypatch.setattr(incremental, "read_raw_nrt", lambda *a: 1 / 0)
    write_events(spark, f"{source}/dt=2025-03-10", ("a", "2025-03-10 02:30:00", "u"))
    stream()
    got = {r["hour_ts"].hour: r["edit_count"] for r in marts.read_edits_hourly(spark, mart).collect()}
    assert got == {2: 2}
    known = incremental.MartState(spark, f"{state}-deliveries")
    assert sorted(r["event_id"] for r in known.current.read().collect()) == ["a", "b"]
    # Only the bucket of an event that comes is listed and read, and none of it is a raw row.
    [label] = known.current.read().where("event_id = 'a'").select("bucket").first()
    bucket = known.current.read(values=[label])
    assert all(f"/current/bucket={label}/" in path for path in bucket.inputFiles())
    batch = spark.createDataFrame([], schemas.RAW_NRT)
    plan = deliveries.changes(deliveries.newest(batch), bucket, None)
    assert plan.inputFiles() == [] or set(plan.inputFiles()) <= set(bucket.inputFiles())


def test_closed_days_keep_their_history(spark, tmp_path):
    names = ("buffer", "raw", "mart", "state", "horizon", "expired")
    source, raw, mart, state, closed, expired = (str(tmp_path / n) for n in names)

    def stream():
        events = incremental.buffer_stream(spark, source)
        run(incremental.mart_stream(spark, events, raw, mart, state, None, closed, expired))
        return {(r["dt"], r["hour_ts"].hour): r["edit_count"] for r in marts.read_edits_hourly(spark, mart).collect()}

    write_events(spark, f"{source}/dt=2025-03-01", *[(f"e{i}", "2025-03-01 01:00:00", "u") for i in range(100)])
    write_events(spark, f"{source}/dt=2025-03-09", ("n", "2025-03-09 01:00:00", "u"))
    assert stream() == {("2025-03-01", 1): 100, ("2025-03-09", 1): 1}
    advance_horizon(spark, closed, first_kept_day(NOW, 5))
    retention.drop_expired_days(spark, raw, NOW)
    write_events(
        spark, f"{source}/dt=2025-03-01",
        ("late", "2025-03-01 01:30:00", "u"), ("n", "2025-03-09 03:00:00", "u"), ("e5", "2025-03-09 03:10:00", "v"),
    )
    # The late one changes nothing; an event of a closed day that comes anew counts where it is now.
    assert stream() == {("2025-03-01", 1): 100, ("2025-03-09", 3): 2}
    assert [r["event_id"] for r in load.read_raw_nrt(spark, expired).collect()] == ["late"]
    assert sorted(r["event_id"] for r in load.read_raw_nrt(spark, raw).collect()) == ["e5", "n", "n"]


def test_the_stream_takes_over_from_loads(spark, tmp_path):
    names = ("buffer", "raw", "manifest", "mart", "state")
    source, raw, manifest, mart, state = (str(tmp_path / n) for n in names)
    write_events(spark, f"{tmp_path}/loaded/dt=2025-03-10", ("a", "2025-03-10 01:00:00", "u"), ("b", "2025-03-10 02:00:00", None))
    load.load_new_files(spark, f"{tmp_path}/loaded", raw, manifest, NOW)
    write_events(spark, f"{source}/dt=2025-03-10", ("a", "2025-03-10 02:30:00", "u"), ("c", "2025-03-10 02:40:00", "u"))
    run(incremental.mart_stream(spark, incremental.buffer_stream(spark, source), raw, mart, state))
    [row] = marts.read_edits_hourly(spark, mart).collect()
    assert (row["hour_ts"].hour, row["edit_count"], row["distinct_editors"]) == (2, 3, 1)


def random_batches(seed):
    """Redeliveries, moves between hours, wikis and editors, ties in time."""
    rng = random.Random(seed)
    for _ in range(4):
        yield [
            (
                f"e{rng.randrange(12)}",
                dt.datetime(2025, 3, 10 + rng.randrange(2), rng.randrange(3), rng.randrange(2), tzinfo=UTC),
                rng.choice("wx"), "edit", None, None, rng.choice(["u", "v", None]), rng.random() < 0.5, *(None,) * 5, "{}",
            )
            for _ in range(rng.randrange(1, 15))
        ]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("dies", [False, True])
def test_adjusting_equals_computing_anew(spark, tmp_path, monkeypatch, seed, dies):
    """Also when every batch dies once before the mart is written and is run again."""
    mart = str(tmp_path / "mart")
    state = incremental.MartState(spark, str(tmp_path / "state"), buckets=3)
    everything = spark.createDataFrame([], schemas.RAW_NRT)
    for version, rows in enumerate(random_batches(seed)):
        batch = spark.createDataFrame(rows, schemas.RAW_NRT)
        everything = everything.unionByName(batch)
        if dies:
            with monkeypatch.context() as patched:
                patched.setattr(incremental, "put_hours", lambda *a: 1 / 0)
                try:
                    state.adjust(batch, version, mart, None)
                except ZeroDivisionError:
                    pass
        state.adjust(batch, version, mart, None)
        if dies:
            state.adjust(batch, version, mart, None)
        got = sorted(map(repr, marts.read_edits_hourly(spark, mart).drop("dt").collect()))
        assert got == sorted(map(repr, marts.edits_hourly(everything).collect()))


def test_flushes_are_recorded_last_and_bounded(spark, tmp_path):
    source, out, bad, state, log = (str(tmp_path / n) for n in ("topic", "buffer", "bad", "state", "log"))
    for _ in range(3):
        publish(spark, source, payload("a"), b"{cut")
    records = spark.readStream.schema(schemas.TOPIC_RECORD).option("maxFilesPerTrigger", 1).parquet(source)
    run(landing.landing_stream(records, out, bad, state, lambda: NOW, log))
    flushes = read_flushes(spark, log)
    assert sorted(r["flush_id"] for r in flushes.collect()) == [0, 1, 2]
    assert tuple(offsets.flush_tallies(flushes).first()) == (3, 3)
    assert [tuple(r) for r in offsets.landed_offsets(flushes).collect()] == [("t", 0, 2)]


def test_streaming_hours_are_final_and_deduplicated(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("buffer", "mart", "state"))
    write_events(
        spark, f"{source}/dt=2025-03-10",
        ("a", "2025-03-10 01:00:00", "u"), ("a", "2025-03-10 01:00:00", "u"),
        ("b", "2025-03-10 01:30:00", "v"), ("c", "2025-03-10 05:00:00", "u"),
    )
    events = incremental.deduplicated_stream(incremental.buffer_stream(spark, source), "1 hour")
    hourly = incremental.hourly_activity_stream(events)
    writer = hourly.writeStream.format("parquet").option("checkpointLocation", state)
    writer.trigger(availableNow=True).start(out).awaitTermination()
    rows = spark.read.schema(schemas.EDITS_HOURLY).parquet(out)
    got = [(r["wiki"], r["edit_count"], r["distinct_editors"]) for r in rows.collect()]
    assert got == [("w", 2, 2)]
    assert rows.select(F.hour("hour_ts")).first()[0] == 1


def test_batches_of_the_landing_queries_are_bounded_and_spread(spark, tmp_path, monkeypatch):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3), i, "view", 1.0, '{"k": %d}' % i) for i in range(400)]
    columns = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(queries, "TOPIC_FILE_RECORDS", 5)
    monkeypatch.setattr(queries, "TOPIC_FILES_PER_CORE", 2)
    _, flushes = queries._land(spark, str(tmp_path))
    per_flush = flushes.groupBy("flush_id").agg(F.sum(F.col("accepted") + F.col("rejected")).alias("n")).collect()
    cores = spark.sparkContext.defaultParallelism
    assert sum(r["n"] for r in per_flush) == 400
    assert max(r["n"] for r in per_flush) <= 5 * 2 * cores
    assert len(per_flush) >= 400 // (5 * 2 * cores)
