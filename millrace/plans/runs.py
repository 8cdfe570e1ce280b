"""The recurring runs, as plain functions for whatever schedules them."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace import schemas, storage
from millrace.cursor import report_change, report_new_files
from millrace.horizon import advance_horizon, first_kept_day, read_horizon
from millrace.layout import Layout
from millrace.operators import retention
from millrace.operators.staging import stg_events_batch
from millrace.plans import load, marts
from millrace.session import work_dir
from millrace.sinks.tables import append_raw_batch
from millrace.sources.buffer import file_inventory
from millrace.sources.captures import decode_frames, with_payload
from millrace.sources.responses import explode_top, read_reports, report_errors


@dataclass(frozen=True)
class HourlyResult:
    loaded: load.LoadResult
    hours_computed: int


@dataclass(frozen=True)
class ReportResult:
    rows_stored: int
    reports_broken: int


@dataclass(frozen=True)
class ObservationResult:
    """What came since the last look: new buffer files, and the article table's state if it changed."""

    new_files: DataFrame
    changed: DataFrame


@dataclass(frozen=True)
class CleanupResult:
    files_deleted: int
    days_dropped: list[dt.date]


def hourly_run(
    spark: SparkSession,
    layout: Layout,
    start: dt.datetime,
    now: dt.datetime,
    since: dt.date | None = None,
    lookback_hours: int = 1,
) -> HourlyResult:
    """Load new buffer files, then fill the hours of the mart that are due.

    Due are also hours that this or an earlier load has changed after they were filled.
    """
    horizon = read_horizon(spark, layout.horizon)
    loaded = load.load_new_files(
        spark,
        layout.buffer,
        layout.raw_nrt,
        layout.manifest,
        now,
        since,
        planned_root=layout.planned_loads,
        dirty_root=layout.dirty_hours,
        horizon=horizon,
        expired_root=layout.expired_deliveries,
    )
    raw = load.read_raw_nrt(spark, layout.raw_nrt)
    hours = marts.refresh(
        spark,
        raw,
        layout.edits_hourly,
        layout.ledger,
        start,
        now,
        lookback_hours,
        dirty_root=layout.dirty_hours,
        horizon=horizon,
    )
    return HourlyResult(loaded, hours)


def report_run(
    spark: SparkSession, layout: Layout, answers: DataFrame, fetched_at: dt.datetime
) -> ReportResult:
    """Store the articles of the good reports, and record which reports are broken and why.

    Every answer is parsed once: the parsed reports are written aside first.
    """
    aside = work_dir(spark, "reports")
    parsed = read_reports(answers).select(*schemas.REPORTS.names)
    try:
        parsed.write.parquet(aside)
        reports = spark.read.schema(schemas.REPORTS).parquet(aside)
        rows = append_raw_batch(explode_top(reports), layout.raw_batch, fetched_at)
        broken = Observation()
        listed = report_errors(reports).withColumn("fetched_at", F.lit(fetched_at).cast("timestamp"))
        listed = listed.observe(broken, F.count("*").alias("reports"))
        listed.hint("rebalance").write.mode("append").parquet(layout.report_errors)
        return ReportResult(rows, storage.observed(broken, "reports"))
    finally:
        storage.delete(spark, aside)


def observe_run(spark: SparkSession, layout: Layout, since: dt.date | None = None) -> ObservationResult:
    """Look at the buffer and the article table; every file and every change comes up once.

    Of several observers at a time each gets a part. Files of days before ``since`` are neither
    listed nor remembered.
    """
    raw_batch = storage.read_table(spark, layout.raw_batch, schemas.RAW_BATCH, "month")
    return ObservationResult(
        report_new_files(spark, file_inventory(spark, layout.buffer, since), layout.seen_files),
        report_change(spark, raw_batch, layout.seen_reports),
    )


def pageviews_top(spark: SparkSession, layout: Layout) -> DataFrame:
    """The daily top articles, straight from the raw table."""
    raw = storage.read_table(spark, layout.raw_batch, schemas.RAW_BATCH, "month")
    return marts.pageviews_top(stg_events_batch(raw))


def captured_messages(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Frames of captured connections that are worth forwarding to a topic."""
    return with_payload(decode_frames(spark, paths))


def cleanup_run(
    spark: SparkSession,
    layout: Layout,
    now: dt.datetime,
    buffer_days: int = 1,
    table_days: int = 5,
) -> CleanupResult:
    """Remove loaded buffer files and raw rows past retention. The marts are kept for good.

    A manifest row must outlive its file, or the file would be loaded again. The days whose raw
    rows go are closed before the first of them goes.
    """
    if buffer_days >= table_days:
        raise ValueError("buffer files must expire before the manifest rows that list them")
    deleted = load.delete_loaded_files(
        spark, layout.buffer, layout.manifest, now, buffer_days, planned_root=layout.planned_loads
    )
    advance_horizon(spark, layout.horizon, first_kept_day(now, table_days))
    dropped = retention.drop_expired_days(spark, layout.raw_nrt, now, table_days)
    retention.rewrite_retained(
        spark,
        layout.raw_batch,
        schemas.RAW_BATCH,
        "month",
        retention.is_retained(F.col("date"), now, table_days),
    )
    retention.rewrite_retained(
        spark,
        layout.manifest,
        schemas.MANIFEST,
        "dt",
        F.col("loaded_at") + F.make_interval(days=F.lit(table_days)) > F.lit(now),
    )
    retention.compact_partitions(spark, layout.manifest, schemas.MANIFEST, "dt")
    marts.compact_ledger(spark, layout.ledger)
    return CleanupResult(deleted, dropped)
