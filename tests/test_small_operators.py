import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace import schemas, session, storage
from millrace.functions import dates
from millrace.operators import files, numbering, offsets, replay, retention
from millrace.plans import marts, quality
from millrace.sinks import topic as topic_sink
from millrace.sources import responses
from millrace.sources import topic as topic_source

UTC = dt.timezone.utc
NOW = dt.datetime(2025, 3, 10, 12, tzinfo=UTC)
DAY = dt.date(2025, 3, 9)


def one(frame):
    return frame.first().asDict()


# ---- reports ------------------------------------------------------------------------


def read(spark, payload):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    answers = spark.createDataFrame(
        [(DAY, "p", "x", text)], "date date, project string, access string, payload string"
    )
    reports = responses.read_reports(answers)
    return reports.first()["error"], [tuple(r) for r in responses.explode_top(reports).collect()]


ARTICLES = [{"article": "A", "views": 9, "rank": 1}, {"article": "B", "views": 5}]


@pytest.mark.parametrize(
    ("payload", "usable", "rows"),
    [
        ({"items": [{"project": "other", "articles": ARTICLES}]}, True, [(DAY, "p", "x", "A", 9, 1), (DAY, "p", "x", "B", 5, None)]),
        ({"items": [{"articles": ARTICLES[:1]}, {"articles": ARTICLES}]}, True, [(DAY, "p", "x", "A", 9, 1)]),
        ({"items": []}, True, []),
        ({"items": None}, True, []),
        ({"items": [{"project": "p"}]}, True, []),
        ({"items": [{"articles": []}]}, True, []),
        ({"detail": "not found"}, False, []),
        ({"items": [{"articles": 5}]}, False, []),
        ({"items": ["x"]}, False, []),
        ({"items": [{"articles": ["x"]}]}, False, []),
        ([], False, []),
        ("no json", False, []),
    ],
)
def test_reports(spark, payload, usable, rows):
    error, got = read(spark, payload)
    assert (error == "") == usable
    assert got == rows


def test_request_plan_pads_dates(spark):
    targets = spark.createDataFrame(
        [("p", "all", dt.date(2025, 1, 31), dt.date(2025, 2, 1))],
        "project string, access string, first_day date, last_day date",
    )
    urls = [r["url"] for r in responses.request_plan(targets, "https://h/v1").sort("date").collect()]
    assert urls == [
        "https://h/v1/metrics/pageviews/top/p/all/2025/01/31",
        "https://h/v1/metrics/pageviews/top/p/all/2025/02/01",
    ]


# ---- numbering ----------------------------------------------------------------------


@pytest.mark.parametrize("groups", [1, 3, 40])
def test_numbered_equals_a_window(spark, groups):
    rng = random.Random(groups)
    # One group holds most rows.
    rows = [(0 if rng.random() < 0.6 else rng.randrange(groups), rng.randrange(50), i) for i in range(3000)]
    frame = spark.createDataFrame(rows, "g int, v int, i int")
    got = numbering.numbered(frame, ["g"], [F.desc("v"), F.asc("i")], "n")
    expected, seen = set(), {}
    for g, v, i in sorted(rows, key=lambda r: (r[0], -r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        expected.add((g, v, i, seen[g]))
    assert {tuple(r) for r in got.collect()} == expected


def test_numbered_without_groups_and_with_null_groups(spark):
    frame = spark.createDataFrame([(None, 2), (None, 1), ("a", 3)], "g string, v int")
    by_group = numbering.numbered(frame, ["g"], ["v"], "n")
    assert {tuple(r) for r in by_group.collect()} == {(None, 1, 1), (None, 2, 2), ("a", 3, 1)}
    overall = numbering.numbered(frame, [], ["v"], "n")
    assert sorted((r["v"], r["n"]) for r in overall.collect()) == [(1, 1), (2, 2), (3, 3)]


def test_load_batches(spark):
    listed = spark.createDataFrame([(f"f{i:03}",) for i in range(95)], "file_path string")
    batches = files.load_batches(listed.repartition(4)).groupBy("batch_no").count().sort("batch_no")
    assert [tuple(r) for r in batches.collect()] == [(0, 40), (1, 40), (2, 15)]


# ---- offsets and replay -------------------------------------------------------------


def test_next_offsets_never_go_back(spark):
    seen = spark.createDataFrame(
        [("t", 0, 5), ("t", 0, 3), ("t", 1, 0), ("u", 0, 9)], "topic string, partition int, offset bigint"
    )
    assert {tuple(r) for r in offsets.next_offsets(seen).collect()} == {("t", 0, 6), ("t", 1, 1), ("u", 0, 10)}


def test_consumer_lag(spark):
    committed = spark.createDataFrame(
        [("t", 0, 7), ("t", 1, -1), ("t", 2, 10)], "topic string, partition int, committed bigint"
    )
    marks = spark.createDataFrame(
        [("t", 0, 0, 10), ("t", 1, 4, 10), ("t", 2, 0, 10), ("t", 3, 0, 99)],
        "topic string, partition int, low bigint, high bigint",
    )
    lag = {(r["partition"]): r["lag"] for r in offsets.consumer_lag(committed, marks).collect()}
    assert lag == {0: 3, 1: 6, 2: 0, None: 9}  # partition 3 was never committed and is left out
    assert one(quality.lag_check(committed, marks, 9))["passed"] is True
    assert one(quality.lag_check(committed, marks, 8)) == {
        "check": "consumer_lag", "passed": False, "value": 9, "threshold": 8,
    }
    assert one(quality.lag_check(committed.limit(0), marks))["value"] == 0


@pytest.mark.parametrize(
    ("last_id", "age", "resumed"),
    [(None, 5.0, None), ("x", 5.0, "x"), ("x", 900.0, "x"), ("x", 901.0, None), ("x", None, "x")],
)
def test_resume(spark, last_id, age, resumed):
    stored = spark.createDataFrame([(last_id, age)], "last_event_id string, age_seconds double")
    row = replay.resume_positions(stored).first()
    assert (row["resume_id"], row["start_at"]) == (resumed, "stored" if resumed else "latest")


def test_lag_reads_what_the_flushes_recorded(spark):
    flushes = spark.createDataFrame(
        [(0, NOW, "t", 0, 5, 4, 1), (1, NOW, "t", 0, 9, 3, 1), (1, NOW, "t", 0, 9, 3, 1), (0, NOW, "t", 1, 2, 0, 2)],
        schemas.FLUSHES,
    )
    marks = spark.createDataFrame([("t", 0, 0, 10), ("t", 1, 0, 2)], "topic string, partition int, low bigint, high bigint")
    lag = {r["partition"]: r["lag"] for r in offsets.consumer_lag(offsets.committed_by(flushes), marks).collect()}
    assert lag == {0: 1, 1: 0, None: 1}
    assert tuple(offsets.flush_tallies(flushes).first()) == (7, 4)
    assert tuple(offsets.flush_tallies(flushes.limit(0)).first()) == (0, 0)


def test_bounded_replay_keeps_the_boundary(spark):
    ages = [0, 900, 901]
    rows = [(a, NOW - dt.timedelta(seconds=a)) for a in ages]
    events = spark.createDataFrame(rows, "age int, event_dt timestamp")
    assert sorted(r["age"] for r in replay.bounded_replay(events, NOW).collect()) == [0, 900]


def test_starting_offsets():
    stored = {1: 7, 0: 5}
    at = '{"t": {"0": 5, "1": 7}}'
    assert [replay.starting_offsets("t", stored, a) for a in (None, 5, 900, 901)] == [at] * 3 + ["latest"]
    assert [replay.starting_offsets("t", nothing, 5) for nothing in (None, {})] == ["latest"] * 2


# ---- topics -------------------------------------------------------------------------


def test_topic_records_keep_a_missing_key_and_the_exact_payload(spark):
    frames = spark.createDataFrame([("1", "dä"), (None, "x")], "id string, data string").coalesce(1)
    rows = topic_sink.topic_records(frames, "t").collect()
    assert [(r["key"], bytes(r["value"]), r["topic"]) for r in rows] == [
        (bytearray(b"1"), "dä".encode(), "t"), (None, b"x", "t"),
    ]


def test_topic_options():
    options = topic_source.topic_options("h:1", "t", "g")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t"
    assert (options["minOffsetsPerTrigger"], options["maxTriggerDelay"]) == ("500", "30s")
    assert options["maxOffsetsPerTrigger"] == "500000"
    assert topic_source.topic_options("h:1", "t", "g", max_records=7)["maxOffsetsPerTrigger"] == "7"
    assert topic_sink.PRODUCER["kafka.acks"] == "all"


# ---- retention ----------------------------------------------------------------------


def test_rows_are_kept_five_days_after_their_day(spark):
    times = [NOW - dt.timedelta(days=d) for d in range(8)]
    frame = spark.createDataFrame([(t,) for t in times], "at timestamp")
    kept = retention.ttl_retained(frame, "at", NOW).select(F.datediff(F.lit(NOW), "at"))
    assert sorted(r[0] for r in kept.collect()) == [0, 1, 2, 3, 4]


def test_expired_days_are_dropped_whole(spark, tmp_path):
    root = str(tmp_path / "t")
    days = [(f"2025-03-{d:02}", d) for d in range(1, 11)]
    spark.createDataFrame(days, "dt string, v int").write.partitionBy("dt").parquet(root)
    (tmp_path / "t" / "dt=odd").mkdir()
    dropped = retention.drop_expired_days(spark, root, NOW)
    assert [d.day for d in dropped] == [1, 2, 3, 4, 5]
    assert storage.subdirectories(spark, root) == [f"dt=2025-03-{d:02}" for d in range(6, 11)] + ["dt=odd"]


def test_partly_expired_partitions_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "t")
    schema = schemas.RAW_BATCH
    dates_in = [dt.date(2025, 1, 1), dt.date(2025, 3, 1), dt.date(2025, 3, 9), dt.date(2025, 4, 1)]
    rows = spark.createDataFrame([(d, "p", "x", "a", 1, 1, NOW) for d in dates_in], schema)
    rows.withColumn("month", dates.month_label(F.col("date"))).write.partitionBy("month").parquet(root)
    for _ in range(2):
        keep = retention.is_retained(F.col("date"), NOW)
        retention.rewrite_retained(spark, root, schema, "month", keep)
        left = storage.read_table(spark, root, schema, "month")
        assert sorted(r["date"] for r in left.collect()) == [dt.date(2025, 3, 9), dt.date(2025, 4, 1)]
    assert storage.subdirectories(spark, root) == ["month=202503", "month=202504"]


# ---- checks -------------------------------------------------------------------------


def test_backlog_check(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("c",)], "file_path string")
    manifest = spark.createDataFrame([("a",), ("gone",)], "file_path string")
    assert one(quality.backlog_check(listed, manifest, 2)) == {
        "check": "backlog_files", "passed": True, "value": 2, "threshold": 2,
    }
    assert one(quality.backlog_check(listed, manifest, 1))["passed"] is False


def test_raw_batch_freshness(spark):
    table = spark.createDataFrame([(NOW,), (NOW - dt.timedelta(days=1),)], "fetched_at timestamp")
    assert one(quality.raw_batch_freshness(table, None))["status"] == "changed"
    assert one(quality.raw_batch_freshness(table, NOW))["status"] == "unchanged"
    empty = one(quality.raw_batch_freshness(table.limit(0), NOW))
    assert empty == {"max_fetched_at": None, "row_count": 0, "status": "empty"}


def test_source_freshness(spark):
    rows = spark.createDataFrame(
        [("a", NOW - dt.timedelta(seconds=90)), ("a", NOW - dt.timedelta(seconds=30))],
        "source string, arrived_at timestamp",
    )
    assert one(quality.source_freshness(rows, NOW))["age_seconds"] == 30.0


def test_grain_and_wiki_checks(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("", 1), (None, 2)], "wiki string, hour_ts int")
    found = quality.grain_violations(rows, schemas.GRAINS["edits_hourly"]).collect()
    assert [tuple(r) for r in found] == [("a", 1, 2)]
    assert one(quality.audit_check(rows))["value"] == 2
    assert one(quality.audit_check(rows.where("wiki = 'a'")))["passed"] is True


def test_small_files_are_compacted(spark, tmp_path):
    root = str(tmp_path / "manifest")
    for n in range(5):
        day = "2025-03-09" if n < 4 else "2025-03-10"
        spark.createDataFrame([(f"f{n}", NOW, n)], schemas.MANIFEST).withColumn("dt", F.lit(day)).coalesce(1).write.mode(
            "append"
        ).partitionBy("dt").parquet(root)
    before = storage.read_table(spark, root, schemas.MANIFEST, "dt")
    rows = sorted(before.collect())
    assert retention.compact_partitions(spark, root, schemas.MANIFEST, "dt", max_files=3) == ["2025-03-09"]
    after = storage.read_table(spark, root, schemas.MANIFEST, "dt")
    assert sorted(after.collect()) == rows
    assert after.where("dt = '2025-03-09'").select("_metadata.file_path").distinct().count() == 1
    assert retention.compact_partitions(spark, str(tmp_path / "none"), schemas.MANIFEST, "dt") == []


def test_ledger_is_compacted_to_the_last_filling(spark, tmp_path):
    root = str(tmp_path / "ledger")
    for minutes in (0, 5, 9):
        rows = [(NOW, NOW + dt.timedelta(minutes=minutes))]
        spark.createDataFrame(rows, schemas.LEDGER).coalesce(1).write.mode("append").parquet(root)
    marts.compact_ledger(spark, root)
    [row] = marts.read_ledger(spark, root).collect()
    assert row["filled_at"].minute == (NOW + dt.timedelta(minutes=9)).minute


# ---- dates and session --------------------------------------------------------------


def test_strict_dates(spark):
    labels = ["2025-03-09", "2025", "2025-03", "2025-3-9", "20250309", "2025-02-30", "not-a-date", ""]
    frame = spark.createDataFrame([(x,) for x in labels], "x string").coalesce(1)
    got = [r[0] for r in frame.select(dates.strict_date(F.col("x"))).collect()]
    assert got == [DAY] + [None] * 7


def test_labels(spark):
    frame = spark.createDataFrame([(NOW, DAY)], "t timestamp, d date")
    row = frame.select(
        dates.compact_day(F.col("t")), dates.month_label(F.col("d")), dates.target_day(F.col("d"))
    ).first()
    assert tuple(row) == ("20250310", "202503", dt.date(2025, 3, 8))


def test_scratch_is_the_folder_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    first, second = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert first != second
    if named:
        assert first.startswith(named)
