"""Every operator as a query over the supplied tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace import cursor, horizon, inputs, schemas, storage
from millrace.functions.dates import compact_day, day_label, hour_start, month_label, target_day
from millrace.operators import contract, files, intervals, offsets, replay, retention, staging
from millrace.plans import checks, load, marts, quality
from millrace.session import configure, work_dir
from millrace.sinks import buffer as buffer_sink
from millrace.sinks import tables, topic
from millrace.sources import buffer as buffer_source
from millrace.sources import captures, responses
from millrace.streaming import incremental, landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

UTC = dt.timezone.utc
FETCHED_AT = dt.datetime(2024, 2, 1, 6, tzinfo=UTC)
RECEIVED_AT = dt.datetime(2024, 2, 1, 12, tzinfo=UTC)
SINCE = dt.date(2024, 1, 15)
DAY = (dt.datetime(2024, 1, 10, tzinfo=UTC), dt.datetime(2024, 1, 11, tzinfo=UTC))
BASE_URL = "https://reports.example.org/v1"
# Files of the topic stand-in: a batch of theirs keeps every core busy and fits in memory.
TOPIC_FILE_RECORDS, TOPIC_FILES_PER_CORE = 50_000, 4


def query(run: Query) -> Query:
    """Register a query under its function's name, with the session set up for it."""

    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return inputs.portable(run(configure(spark), sf_dir))

    QUERIES[run.__name__] = prepared
    return run


def _event_number() -> Column:
    return F.regexp_extract("raw_json", r"ev-(\d+)", 1).cast("bigint")


# ---- staging and marts --------------------------------------------------------------


@query
def stg_events_nrt(spark, sf_dir):
    return staging.stg_events_nrt(inputs.raw_nrt(spark, sf_dir))


@query
def drifting_events(spark, sf_dir):
    return staging.drifting_events(inputs.raw_nrt(spark, sf_dir))


@query
def edits_hourly(spark, sf_dir):
    return marts.edits_hourly(inputs.raw_nrt(spark, sf_dir))


@query
def edits_hourly_interval(spark, sf_dir):
    return marts.edits_hourly(inputs.raw_nrt(spark, sf_dir), *DAY)


@query
def edits_hourly_backfill(spark, sf_dir):
    """Everything, then one day again: a repeated interval is replaced, not added."""
    raw = inputs.raw_nrt(spark, sf_dir)
    now = inputs.latest_event(spark, sf_dir) + dt.timedelta(hours=1)
    mart, ledger = work_dir(spark, "mart"), work_dir(spark, "ledger")
    start = inputs.instant(inputs.events(spark, sf_dir).agg(F.min("ts").alias("at")), "at")
    marts.backfill(spark, raw, mart, ledger, start, now, now, retention_days=None)
    marts.backfill(spark, raw, mart, ledger, *DAY, now, retention_days=None)
    return marts.read_edits_hourly(spark, mart).drop("dt")


@query
def stg_events_batch(spark, sf_dir):
    return staging.stg_events_batch(inputs.raw_batch(spark, sf_dir))


@query
def pageviews_top(spark, sf_dir):
    return marts.pageviews_top(staging.stg_events_batch(inputs.raw_batch(spark, sf_dir)))


@query
def missing_intervals(spark, sf_dir):
    events = inputs.events(spark, sf_dir)
    bounds = events.agg(
        F.min("ts").alias("first_hour"),
        (F.max("ts") + F.expr("interval 1 hour")).alias("end_hour"),
    )
    filled = events.where(F.hour("ts") % 6 != 0).select(hour_start(F.col("ts")).alias("hour_ts"))
    return intervals.missing_intervals(intervals.hours_between(bounds), filled)


@query
def late_events(spark, sf_dir):
    return intervals.late_event_profile(inputs.arrivals(spark, sf_dir), lookback_hours=1)


@query
def dirty_intervals(spark, sf_dir):
    """All hours are filled; then every fiftieth event is delivered again, two hours later."""
    landed, raw, manifest, dirty, ledger = (work_dir(spark, d) for d in ("buffer", "raw-nrt", "manifest", "dirty", "ledger"))
    events = inputs.events(spark, sf_dir)
    _buffer(spark, events, landed)
    load.load_new_files(spark, landed, raw, manifest, RECEIVED_AT)
    filled = events.select(hour_start(F.col("ts")).alias("hour_ts"), F.lit(RECEIVED_AT).alias("filled_at"))
    filled.distinct().write.parquet(ledger)
    moved = events.where(inputs.every(50)).withColumn("ts", F.col("ts") + F.expr("interval 2 hours"))
    _buffer(spark, moved, landed)
    load.load_new_files(spark, landed, raw, manifest, RECEIVED_AT, dirty_root=dirty)
    return intervals.dirty_intervals(marts.read_dirty_hours(spark, dirty), marts.read_ledger(spark, ledger))


@query
def expired_deliveries(spark, sf_dir):
    """Old versions of every fifteenth event that come when the days before ``SINCE`` are closed."""
    landed, raw, manifest, closed, expired = (work_dir(spark, d) for d in ("buffer", "raw-nrt", "manifest", "horizon", "expired"))
    events = inputs.events(spark, sf_dir)
    older = events.where(inputs.every(15)).withColumn("ts", F.col("ts") - F.expr("interval 5 seconds"))
    _buffer(spark, events, landed)
    load.load_new_files(spark, landed, raw, manifest, RECEIVED_AT)
    limit = horizon.advance_horizon(spark, closed, SINCE)
    _buffer(spark, older, landed)
    load.load_new_files(spark, landed, raw, manifest, RECEIVED_AT, horizon=limit, expired_root=expired)
    return load.read_raw_nrt(spark, expired).select("event_id", "event_dt", "wiki", "dt")


# ---- contract -----------------------------------------------------------------------


@query
def validate_events(spark, sf_dir):
    judged = contract.validate(inputs.payloads(spark, sf_dir))
    return judged.select(
        _event_number().alias("event_no"), (F.col("error") == "").alias("valid"), "error"
    )


@query
def flatten_events(spark, sf_dir):
    return contract.accepted(contract.validate(inputs.payloads(spark, sf_dir)))


@query
def flush_tallies(spark, sf_dir):
    """As the landing stream recorded them."""
    return offsets.flush_tallies(_land(spark, sf_dir)[1])


@query
def dead_letter(spark, sf_dir):
    """Written and read back."""
    root = work_dir(spark, "dead-letter")
    judged = contract.validate(inputs.payloads(spark, sf_dir))
    buffer_sink.write_dead_letters(contract.rejected(judged), root, RECEIVED_AT)
    return spark.read.schema(schemas.with_partition(schemas.DEAD_LETTER, "dt")).json(root)


# ---- captures, topics, reports ------------------------------------------------------


@query
def sse_decode(spark, sf_dir):
    root = work_dir(spark, "captures")
    inputs.write_captures(spark, sf_dir, root)
    frames = captures.with_payload(captures.decode_frames(spark, root))
    connection = F.regexp_extract("file", r"connection=(\d+)", 1).cast("bigint")
    return frames.select(connection.alias("connection"), "frame", "id", "event", "data")


@query
def topic_records(spark, sf_dir):
    frames = inputs.payloads(spark, sf_dir).select(
        F.when(inputs.every(3, 1), F.lit(None)).otherwise(F.col("event_id").cast("string")).alias("id"),
        F.col("raw_line").alias("data"),
    )
    records = topic.topic_records(frames, inputs.TOPIC)
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.md5("value").alias("value_md5"),
        F.octet_length("value").cast("bigint").alias("value_bytes"),
        "topic",
    )


@query
def pageviews_explode(spark, sf_dir):
    return responses.explode_top(responses.read_reports(inputs.reports(spark, sf_dir)))


@query
def report_errors(spark, sf_dir):
    return responses.report_errors(responses.read_reports(inputs.reports(spark, sf_dir)))


@query
def target_days(spark, sf_dir):
    """The day each day's request asks for, and the labels of both."""
    day = F.to_date("l_shipdate")
    days = inputs.table(spark, sf_dir, "lineitem").select(day.alias("today")).distinct()
    asked = days.withColumn("target", target_day(F.col("today")))
    return asked.select("today", "target", compact_day(F.col("today")).alias("today_label"), month_label(F.col("target")).alias("target_month"))


@query
def request_plan(spark, sf_dir):
    shipped = F.to_date("l_shipdate")
    targets = (
        inputs.table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_returnflag").alias("project"), F.col("l_linestatus").alias("access"))
        .agg(F.min(shipped).alias("first_day"), F.max(shipped).alias("last_day"))
    )
    return responses.request_plan(targets, BASE_URL)


@query
def raw_batch_rows(spark, sf_dir):
    """Written by month and read back."""
    articles = responses.explode_top(responses.read_reports(inputs.reports(spark, sf_dir)))
    root = work_dir(spark, "raw-batch")
    tables.append_raw_batch(articles, root, FETCHED_AT)
    return spark.read.schema(schemas.with_partition(schemas.RAW_BATCH, "month")).parquet(root)


# ---- buffer and load ----------------------------------------------------------------


def _buffer(spark: SparkSession, rows: DataFrame, root: str) -> None:
    flat = inputs.flat_events(rows)
    buffer_sink.write_buffer(flat.withColumn("dt", day_label(F.col("event_dt"))), root)


@query
def scan_since(spark, sf_dir):
    root = work_dir(spark, "buffer")
    _buffer(spark, inputs.events(spark, sf_dir), root)
    return buffer_source.scan_since(spark, root, SINCE).select("event_id", "event_dt", "wiki", "bot", "dt")


@query
def file_inventory(spark, sf_dir):
    root = work_dir(spark, "buffer")
    _buffer(spark, inputs.events(spark, sf_dir), root)
    listed = buffer_source.file_inventory(spark, root, SINCE)
    paths = [row["file_path"] for row in listed.select("file_path").collect()]  # one file per day
    counts = buffer_source.file_row_counts(spark, paths)
    return listed.join(counts, "file_path", "left").groupBy("dt").agg(
        F.sum("row_count").alias("row_count"), (F.min("bytes") > 0).alias("all_filled")
    )


def _load_in_two_drops(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Two drops, a load after each and one more with nothing new."""
    landed, raw, manifest = (work_dir(spark, d) for d in ("buffer", "raw-nrt", "manifest"))
    events = inputs.events(spark, sf_dir)
    for rows in (events.where(~inputs.every(3)), events.where(inputs.every(3))):
        _buffer(spark, rows, landed)
        load.load_new_files(spark, landed, raw, manifest, RECEIVED_AT)
    load.load_new_files(spark, landed, raw, manifest, RECEIVED_AT)
    return raw, manifest


@query
def load_new_files(spark, sf_dir):
    raw, _ = _load_in_two_drops(spark, sf_dir)
    return load.read_raw_nrt(spark, raw)


@query
def raw_file_order(spark, sf_dir):
    """Rows of the raw table that come before a smaller one in the same file: none."""
    raw, _ = _load_in_two_drops(spark, sf_dir)
    placed = load.read_raw_nrt(spark, raw).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        F.struct(*schemas.RAW_NRT_SORT).alias("key"),
    )
    in_file = W.partitionBy("file").orderBy("row")
    ordered = placed.withColumn("before", F.lag("key").over(in_file))
    return ordered.agg(
        F.count("*").alias("row_count"), F.count_if(F.col("before") > F.col("key")).alias("out_of_order")
    )


@query
def manifest_rows(spark, sf_dir):
    _, manifest = _load_in_two_drops(spark, sf_dir)
    recorded = load.read_manifest(spark, manifest)
    return recorded.groupBy("dt", "loaded_at").agg(F.sum("row_count").alias("row_count"))


@query
def new_files(spark, sf_dir):
    listed = inputs.listing(spark, sf_dir)
    return files.new_files(listed, inputs.manifest(listed)).select("file_path")


@query
def loaded_since(spark, sf_dir):
    recorded = inputs.manifest(inputs.listing(spark, sf_dir))
    return files.loaded_since(recorded, dt.datetime(2024, 1, 15, tzinfo=UTC))


@query
def load_batches(spark, sf_dir):
    return files.load_batches(inputs.listing(spark, sf_dir))


@query
def observed_new_files(spark, sf_dir):
    """The listing from ``SINCE`` on, compared with what an unbounded look had seen."""
    listed = inputs.listing(spark, sf_dir)
    window = listed.where(F.regexp_extract("file_path", "dt=([^/]+)", 1) >= SINCE.isoformat())
    return files.observed_files(window, inputs.manifest(listed))


@query
def reported_files(spark, sf_dir):
    """Three looks on one cursor: at the files a load got, and twice at all. Each file is reported once."""
    root = work_dir(spark, "seen-files")
    listed = inputs.listing(spark, sf_dir)
    looks = [inputs.manifest(listed), listed, listed]
    reports = [
        cursor.report_new_files(spark, look.select("file_path"), root).withColumn("look", F.lit(number))
        for number, look in enumerate(looks)
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def reported_changes(spark, sf_dir):
    """Three looks on one cursor: at the older reports twice, then at all. Each change is reported once."""
    root = work_dir(spark, "seen-reports")
    articles = inputs.article_views(spark, sf_dir).withColumn("fetched_at", F.date_add("date", 1).cast("timestamp"))
    older = articles.where(F.year("date") < 1998)
    reports = [
        cursor.report_change(spark, look, root).withColumn("look", F.lit(number))
        for number, look in enumerate([older, older, articles])
    ]
    return reduce(DataFrame.unionByName, reports)


@query
def cleanup_candidates(spark, sf_dir):
    listed = inputs.listing(spark, sf_dir)
    now = inputs.latest_event(spark, sf_dir)
    return files.cleanup_candidates(listed, inputs.manifest(listed), now, 7).select("file_path")


@query
def ttl_retained(spark, sf_dir):
    now = inputs.latest_event(spark, sf_dir)
    rows = inputs.raw_nrt(spark, sf_dir).select("event_id", "event_dt")
    return retention.ttl_retained(rows, "event_dt", now)


# ---- offsets and replay -------------------------------------------------------------


@query
def next_offsets(spark, sf_dir):
    return offsets.next_offsets(inputs.positions(spark, sf_dir))


@query
def consumer_lag(spark, sf_dir):
    seen = inputs.positions(spark, sf_dir)
    return offsets.consumer_lag(inputs.committed(seen), inputs.watermarks(seen))


@query
def bounded_replay(spark, sf_dir):
    events = inputs.events(spark, sf_dir).select("event_id", F.col("ts").alias("event_dt"))
    return replay.bounded_replay(events, inputs.latest_event(spark, sf_dir))


@query
def resume_positions(spark, sf_dir):
    """Each user's last event as a stored position, aged at the end of the data."""
    now = inputs.latest_event(spark, sf_dir)
    stored = (
        inputs.events(spark, sf_dir)
        .groupBy("user_id")
        .agg(
            F.max("event_id").cast("string").alias("last_event_id"),
            F.max(F.unix_micros("ts")).alias("stored_at"),
        )
        .select(
            "user_id",
            "last_event_id",
            F.when(
                F.col("user_id") % 7 != 0,
                F.floor((F.unix_micros(F.lit(now)) - F.col("stored_at")) / 1_000_000),
            ).alias("age_seconds"),
        )
    )
    return replay.resume_positions(stored, 6 * 3600)


# ---- quality ------------------------------------------------------------------------


@query
def audit_not_null_wiki(spark, sf_dir):
    raw = inputs.raw_nrt(spark, sf_dir, blank_wikis=True)
    return marts.without_wiki(marts.edits_hourly(raw))


@query
def audit_check(spark, sf_dir):
    return quality.audit_check(marts.edits_hourly(inputs.raw_nrt(spark, sf_dir, blank_wikis=True)))


@query
def backlog_check(spark, sf_dir):
    listed = inputs.listing(spark, sf_dir)
    return quality.backlog_check(listed, inputs.manifest(listed))


@query
def lag_check(spark, sf_dir):
    seen = inputs.positions(spark, sf_dir)
    return quality.lag_check(inputs.committed(seen), inputs.watermarks(seen))


@query
def raw_batch_freshness(spark, sf_dir):
    articles = inputs.article_views(spark, sf_dir).withColumn(
        "fetched_at", F.date_add("date", 1).cast("timestamp")
    )
    return quality.raw_batch_freshness(articles, FETCHED_AT)


@query
def source_freshness(spark, sf_dir):
    now = inputs.latest_event(spark, sf_dir) + dt.timedelta(hours=2)
    return quality.source_freshness(inputs.arrivals(spark, sf_dir), now)


@query
def grain_violations(spark, sf_dir):
    """Deliveries break the grain their deduplicated view promises."""
    return quality.grain_violations(
        inputs.raw_nrt(spark, sf_dir), schemas.GRAINS["stg_events_nrt"]
    )


@query
def batch_grain_violations(spark, sf_dir):
    """A repeated fetch of every fiftieth article."""
    rows = inputs.article_views(spark, sf_dir).withColumn(
        "article", F.col("l_partkey").cast("string")
    )
    fetched_twice = rows.unionByName(rows.where(F.col("l_partkey") % 50 == 0))
    return quality.grain_violations(fetched_twice, schemas.GRAINS["stg_events_batch"])


@query
def touched_grain_violations(spark, sf_dir):
    """Articles come in three writes, the repeated fetches last; each write's months are checked alone."""
    table, found = work_dir(spark, "articles"), work_dir(spark, "violations")
    rows = inputs.article_views(spark, sf_dir).withColumn("article", F.col("l_partkey").cast("string"))
    rows = rows.withColumn("month", month_label(F.col("date")))
    again, early = F.col("l_partkey") % 50 == 0, F.year("date") < 1998
    grain = schemas.GRAINS["stg_events_batch"]
    violations = checks.violations_table(spark, found, checks.grain_schema(schemas.RAW_BATCH, grain), "month")
    for number, part in enumerate([rows, rows.where(again & early), rows.where(again & ~early)]):
        storage.append_partitioned(part.select(*grain, "month"), table, "month")
        months = [row["month"] for row in part.select("month").distinct().collect()]  # one per year
        stored = spark.read.parquet(table).withColumn("month", F.col("month").cast("string"))
        checks.check_touched(violations, stored, checks.partition_grain(grain, "month"), months, number)
    return violations.read().drop("month")


@query
def touched_audit(spark, sf_dir):
    """A first day without any wiki is found wanting, then put right: checked are that day, all days, ``DAY``."""
    mart, found = work_dir(spark, "mart"), work_dir(spark, "violations")
    rows = marts.edits_hourly(inputs.raw_nrt(spark, sf_dir, blank_wikis=True))
    rows.withColumn("dt", day_label(F.col("hour_ts"))).write.partitionBy("dt").parquet(mart)
    violations = checks.violations_table(spark, found, schemas.EDITS_HOURLY, "dt")
    days = [name.removeprefix("dt=") for name in storage.subdirectories(spark, mart)]
    broken = marts.read_edits_hourly(spark, mart).withColumn("wiki", F.lit(None).cast("string"))
    checks.check_touched(violations, broken.where(F.col("dt") == days[0]), marts.without_wiki, days[:1], 0)
    for number, touched in enumerate([days, [DAY[0].date().isoformat()]], start=1):
        checks.check_touched(violations, marts.read_edits_hourly(spark, mart), marts.without_wiki, touched, number)
    return violations.read().drop("dt")


# ---- streaming ----------------------------------------------------------------------


def _land(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Topic records through the landing stream: the buffer, and what the flushes recorded."""
    source, root, letters, state, flushes = (
        work_dir(spark, d) for d in ("topic", "buffer", "dead-letter", "checkpoint", "flushes")
    )
    inputs.topic_rows(spark, sf_dir).write.option("maxRecordsPerFile", TOPIC_FILE_RECORDS).parquet(source)
    # A bounded number of files of bounded size per batch, as the topic source bounds its records.
    files_per_batch = TOPIC_FILES_PER_CORE * spark.sparkContext.defaultParallelism
    records = (
        spark.readStream.schema(schemas.TOPIC_RECORD).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    )
    stream = landing.landing_stream(records, root, letters, state, lambda: RECEIVED_AT, flushes)
    stream.trigger(availableNow=True).start().awaitTermination()
    return root, buffer_sink.read_flushes(spark, flushes)


@query
def landed_events(spark, sf_dir):
    """What lies in the buffer after the landing stream."""
    return buffer_source.scan_since(spark, _land(spark, sf_dir)[0])


@query
def landed_offsets(spark, sf_dir):
    """Where the landing stream stands in each partition, as its flushes recorded it."""
    return offsets.landed_offsets(_land(spark, sf_dir)[1])


@query
def stream_edits_hourly(spark, sf_dir):
    """All deliveries, the stale ones first, in three runs of the stream on one checkpoint."""
    source, raw, mart, state = (work_dir(spark, d) for d in ("buffer", "raw-nrt", "mart", "checkpoint"))
    rows = inputs.events(spark, sf_dir)
    older = inputs.flat_events(
        rows.where(inputs.every(15)).withColumn("ts", F.col("ts") - F.expr("interval 5 seconds"))
    ).withColumn("wiki", F.lit("stale"))
    for part in (older, inputs.flat_events(rows), inputs.flat_events(rows.where(inputs.every(10)))):
        buffer_sink.write_buffer(part.withColumn("dt", day_label(F.col("event_dt"))), source)
        events = incremental.buffer_stream(spark, source)
        stream = incremental.mart_stream(spark, events, raw, mart, state)
        stream.trigger(availableNow=True).start().awaitTermination()
    return marts.read_edits_hourly(spark, mart).drop("dt")
