import datetime as dt
import json

import pytest

from millrace import schemas, storage
from millrace.layout import Layout
from millrace.plans import load, marts, runs
from millrace.sinks.topic import topic_records
from millrace.sources.buffer import scan_since
from millrace.streaming.landing import land

UTC = dt.timezone.utc
DAY = dt.date(2025, 3, 10)


def at(hour, minute=0, day=DAY):
    return dt.datetime.combine(day, dt.time(hour, minute), UTC)


def message(event_id, when, **changes):
    meta = {"id": event_id, "dt": when.strftime("%Y-%m-%dT%H:%M:%SZ")}
    return json.dumps({"meta": meta, "type": "edit", "wiki": "w", "user": "u", **changes})


def test_layout():
    layout = Layout("/data/")
    assert layout.buffer_partition(DAY) == "/data/nrt/dt=2025-03-10"
    assert layout.dead_letter_partition(DAY) == "/data/dead_letter/nrt/dt=2025-03-10"


def test_from_capture_to_mart_and_cleanup(spark, tmp_path):
    layout = Layout(str(tmp_path / "base"))
    capture = tmp_path / "captures" / "c.txt"
    capture.parent.mkdir()
    frames = [message("a", at(1)), message("b", at(1, 30), bot=True), "{broken", message("a", at(1))]
    capture.write_text("".join(f"id: {i}\ndata: {f}\n\n" for i, f in enumerate(frames)) + "data: cut")

    records = topic_records(runs.captured_messages(spark, str(capture.parent)), "t")
    land(records, layout.buffer, layout.dead_letters, at(1, 45))
    result = runs.hourly_run(spark, layout, at(0), at(2))
    assert result == runs.HourlyResult(load.LoadResult(1, 3), 2)
    assert runs.hourly_run(spark, layout, at(0), at(2), lookback_hours=0) == runs.HourlyResult(
        load.LoadResult(0, 0), 0
    )
    [row] = marts.read_edits_hourly(spark, layout.edits_hourly).collect()
    assert (row["edit_count"], row["bot_edit_count"], row["distinct_editors"]) == (2, 1, 1)

    later = dt.datetime.now(UTC) + dt.timedelta(days=3)  # file age counts from the real clock
    cleaned = runs.cleanup_run(spark, layout, later, table_days=10_000)
    assert cleaned == runs.CleanupResult(1, [])
    assert scan_since(spark, layout.buffer).count() == 0
    assert load.read_raw_nrt(spark, layout.raw_nrt).count() == 3

    gone = runs.cleanup_run(spark, layout, at(12, day=DAY + dt.timedelta(days=20)))
    assert gone.days_dropped == [DAY]
    assert load.read_manifest(spark, layout.manifest).count() == 0
    assert marts.read_edits_hourly(spark, layout.edits_hourly).count() == 1  # kept for good


def test_manifest_rows_must_outlive_their_files(spark, tmp_path):
    with pytest.raises(ValueError):
        runs.cleanup_run(spark, Layout(str(tmp_path)), at(1), buffer_days=5, table_days=5)


def test_reports(spark, tmp_path):
    layout = Layout(str(tmp_path))
    good = json.dumps({"items": [{"articles": [{"article": "A", "views": 9, "rank": r} for r in (1, 101)]}]})
    schema = "date date, project string, access string, payload string"
    answers = lambda text: spark.createDataFrame([(DAY, "p", "x", text)], schema)
    assert runs.report_run(spark, layout, answers(good), at(6)) == runs.ReportResult(2, 0)
    assert [r["rank"] for r in runs.pageviews_top(spark, layout).collect()] == [1]
    both = answers(good).unionByName(answers("{}"))
    assert runs.report_run(spark, layout, both, at(6)) == runs.ReportResult(2, 1)
    [broken] = spark.read.parquet(layout.report_errors).collect()
    assert (broken["date"], broken["project"], broken["error"]) == (DAY, "p", "missing items")
    assert runs.report_run(spark, layout, answers('{"items": []}'), at(6)) == runs.ReportResult(0, 0)
    assert storage.read_table(spark, layout.raw_batch, schemas.RAW_BATCH, "month").count() == 4
    assert runs.pageviews_top(spark, layout).columns == schemas.RAW_BATCH.names[:-1]


def test_observation(spark, tmp_path):
    layout = Layout(str(tmp_path))
    nothing = runs.observe_run(spark, layout)
    assert nothing.new_files.isEmpty() and nothing.changed.isEmpty()
    records = topic_records(spark.createDataFrame([("a", message("a", at(1)))], "id string, data string"), "t")
    land(records, layout.buffer, layout.dead_letters, at(1, 45))
    good = json.dumps({"items": [{"articles": [{"article": "A", "views": 9, "rank": 1}]}]})
    answers = spark.createDataFrame([(DAY, "p", "x", good)], "date date, project string, access string, payload string")
    runs.report_run(spark, layout, answers, at(6))
    first, second = runs.observe_run(spark, layout), runs.observe_run(spark, layout)
    assert (first.new_files.count(), first.changed.first()["row_count"]) == (1, 1)
    assert second.new_files.isEmpty() and second.changed.isEmpty()
