"""The marts: hourly edit activity and the daily top articles."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas, storage
from millrace.functions.dates import day_label, expires_at, hour_start
from millrace.operators import intervals
from millrace.operators.staging import events_for_interval, latest_delivery
from millrace.session import work_dir

# All the hourly mart needs of an event.
_ACTIVITY = ["event_id", "event_dt", "wiki", "user", "bot"]


class AuditFailure(Exception):
    """Recomputed rows broke a rule. The mart and its ledger are as before."""


def hourly_activity(events: DataFrame) -> DataFrame:
    """Edits, bot edits and distinct editors per wiki and hour of deduplicated events.

    Spark counts distinct editors by first grouping on wiki, hour and editor, so one
    wiki with most of the traffic still spreads over all tasks.
    """
    return events.groupBy("wiki", hour_start(F.col("event_dt")).alias("hour_ts")).agg(
        F.count("*").alias("edit_count"),
        F.count_if("bot").alias("bot_edit_count"),
        F.count_distinct("user").alias("distinct_editors"),
    )


def edits_hourly(
    raw: DataFrame, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    """The mart from raw deliveries, for everything or for ``[start, end)``."""
    if start is None or end is None:
        return hourly_activity(latest_delivery(raw, _ACTIVITY))
    return hourly_activity(events_for_interval(raw, F.lit(start), F.lit(end), _ACTIVITY))


def edits_hourly_assuming_stable_time(
    raw: DataFrame, start: dt.datetime, end: dt.datetime
) -> DataFrame:
    """As :func:`edits_hourly`, reading nothing after ``end`` either.

    Right only while every delivery of an event carries the same time;
    :func:`millrace.operators.staging.drifting_events` lists the ids that break that.
    """
    inside = raw.where(intervals.in_interval(F.col("event_dt"), F.lit(start), F.lit(end)))
    if "dt" in raw.columns:
        last = (end - dt.timedelta(microseconds=1)).date().isoformat()
        inside = inside.where(F.col("dt").between(start.date().isoformat(), last))
    return hourly_activity(latest_delivery(inside, _ACTIVITY))


def pageviews_top(stg_events_batch: DataFrame, top: int = 100) -> DataFrame:
    """Articles the report itself ranks within the first ``top``."""
    return stg_events_batch.where(F.col("rank") <= top).drop("fetched_at")


def without_wiki(mart: DataFrame) -> DataFrame:
    """Rows that name no wiki; the audit passes when there are none."""
    return mart.where(F.col("wiki").isNull() | (F.col("wiki") == ""))


def read_edits_hourly(spark: SparkSession, mart_root: str) -> DataFrame:
    return storage.read_table(spark, mart_root, schemas.EDITS_HOURLY, "dt")


def read_ledger(spark: SparkSession, ledger_root: str) -> DataFrame:
    return storage.read_table(spark, ledger_root, schemas.LEDGER)


def _runs(starts: list[dt.datetime]) -> list[tuple[dt.datetime, dt.datetime]]:
    """Sorted hours as half-open stretches without a gap."""
    hour = dt.timedelta(hours=1)
    stretches: list[tuple[dt.datetime, dt.datetime]] = []
    for start in starts:
        if stretches and stretches[-1][1] == start:
            stretches[-1] = (stretches[-1][0], start + hour)
        else:
            stretches.append((start, start + hour))
    return stretches


def _fresh_hours(
    raw: DataFrame, starts: list[dt.datetime], assume_stable_event_time: bool
) -> DataFrame:
    """The mart of the given hours.

    Each stretch of hours is one interval: a stable event time lets it read its own days
    only. Otherwise a later delivery may take an event out of an hour, so everything after
    the first hour is read, once for all stretches.
    """
    stretches = _runs(sorted(starts))
    if assume_stable_event_time:
        parts = [edits_hourly_assuming_stable_time(raw, *stretch) for stretch in stretches]
        return reduce(DataFrame.unionByName, parts)
    first, after = stretches[0][0], stretches[-1][1]
    latest = events_for_interval(raw, F.lit(first), F.lit(after), _ACTIVITY)
    inside = [
        intervals.in_interval(F.col("event_dt"), F.lit(begin), F.lit(end))
        for begin, end in stretches
    ]
    return hourly_activity(latest.where(reduce(Column.__or__, inside)))


def replace_hours(
    spark: SparkSession,
    raw: DataFrame,
    mart_root: str,
    starts: list[dt.datetime],
    assume_stable_event_time: bool = False,
) -> None:
    """Recompute the given hours and put them in place of what the mart has for them.

    The new state of every touched day, its other hours included, is written aside and
    audited first. Only then are the day directories swapped, without reading the mart
    again. A day left without any row has nothing to swap in and is removed.
    """
    put_hours(spark, _fresh_hours(raw, starts, assume_stable_event_time), mart_root, starts)


def put_hours(spark: SparkSession, fresh: DataFrame, mart_root: str, starts: list[dt.datetime]) -> None:
    """Put the rows of the given hours in place of what the mart has for them."""
    hours = spark.createDataFrame([(start,) for start in starts], "hour_ts timestamp")
    days = {start.date().isoformat() for start in starts}
    kept = (
        read_edits_hourly(spark, mart_root)
        .where(F.col("dt").isin(sorted(days)))
        .drop("dt")
        .join(hours, "hour_ts", "left_anti")
    )
    aside = work_dir(spark, "edits-hourly")
    storage.append_partitioned(
        fresh.unionByName(kept).withColumn("dt", day_label(F.col("hour_ts"))), aside, "dt"
    )
    try:
        ready = read_edits_hourly(spark, aside)
        objections = without_wiki(ready).join(hours, "hour_ts", "left_semi").count()
        if objections:
            raise AuditFailure(f"{objections} rows of the hourly mart name no wiki")
        (
            ready.sortWithinPartitions("dt", "wiki", "hour_ts")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("dt")
            .parquet(mart_root)
        )
        filled = {name.removeprefix("dt=") for name in storage.subdirectories(spark, aside)}
        for day in days - filled:
            storage.delete(spark, f"{mart_root.rstrip('/')}/dt={day}")
    finally:
        storage.delete(spark, aside)


def _run(
    spark: SparkSession,
    raw: DataFrame,
    mart_root: str,
    ledger_root: str,
    hours: DataFrame,
    now: dt.datetime,
    assume_stable_event_time: bool,
) -> int:
    """Compute ``hours`` and record them; how many."""
    # A few thousand hours per year: fixed here, so that every step sees the same ones.
    seconds = [row[0] for row in hours.select(F.unix_seconds("hour_ts")).collect()]
    starts = sorted(dt.datetime.fromtimestamp(s, dt.timezone.utc) for s in seconds)
    if not starts:
        return 0
    replace_hours(spark, raw, mart_root, starts, assume_stable_event_time)
    filled = spark.createDataFrame([(start, now) for start in starts], schemas.LEDGER)
    filled.coalesce(1).write.mode("append").parquet(ledger_root)
    return len(starts)


def _hours(spark: SparkSession, start: dt.datetime, end: dt.datetime) -> DataFrame:
    bounds = spark.createDataFrame([(start, end)], "first_hour timestamp, end_hour timestamp")
    return intervals.hours_between(bounds)


def refresh(
    spark: SparkSession,
    raw: DataFrame,
    mart_root: str,
    ledger_root: str,
    start: dt.datetime,
    now: dt.datetime,
    lookback_hours: int = 1,
    retention_days: int = 5,
    assume_stable_event_time: bool = False,
    dirty_root: str | None = None,
    horizon: dt.datetime | None = None,
) -> int:
    """Fill every due hour from ``start`` to the last full one; how many were computed.

    Due are hours not in the ledger, and the last ``lookback_hours`` before the newest:
    their events may have arrived late. The ledger is written last, so a run that dies
    half-way is simply repeated.

    With ``dirty_root`` the hours that loads have marked there are due as well, however far
    back. Marks are taken away after the ledger is written: only those that were there at the
    start, so that a load running meanwhile loses none. ``horizon`` closes the days before it.

    With ``assume_stable_event_time`` the work is in proportion to the hours due: no day
    without one is read. Right only while all deliveries of an event carry the same time,
    which :func:`millrace.operators.staging.drifting_events` checks.
    """
    marks = [] if dirty_root is None else storage.subdirectories(spark, dirty_root)
    due = intervals.due_intervals(
        _hours(spark, start, now),
        read_ledger(spark, ledger_root),
        now,
        lookback_hours,
        retention_days,
        None if dirty_root is None else read_dirty_hours(spark, dirty_root, marks),
        horizon,
    )
    computed = _run(spark, raw, mart_root, ledger_root, due, now, assume_stable_event_time)
    for mark in marks:
        storage.delete(spark, f"{dirty_root.rstrip('/')}/{mark}")
    return computed


def read_dirty_hours(spark: SparkSession, dirty_root: str, marks: list[str] | None = None) -> DataFrame:
    """The hours loads have marked; with ``marks`` those of some loads only."""
    if marks is None:
        marks = storage.subdirectories(spark, dirty_root)
    if not marks:
        return spark.createDataFrame([], schemas.DIRTY_HOURS)
    return spark.read.schema(schemas.DIRTY_HOURS).parquet(*(f"{dirty_root.rstrip('/')}/{mark}" for mark in marks))


def backfill(
    spark: SparkSession,
    raw: DataFrame,
    mart_root: str,
    ledger_root: str,
    start: dt.datetime,
    end: dt.datetime,
    now: dt.datetime,
    retention_days: int | None = 5,
    assume_stable_event_time: bool = False,
    horizon: dt.datetime | None = None,
) -> int:
    """Recompute the full hours of ``[start, end)`` whether or not they were filled.

    Refuses hours whose raw rows retention has removed, and those before ``horizon``. ``retention_days=None`` is for
    raw tables that are kept for good.
    """
    hours = _hours(spark, start, end)
    if horizon is not None and start < horizon:
        raise ValueError("the interval reaches back into closed days")
    if retention_days is not None:
        lost = hours.where(expires_at(F.col("hour_ts"), retention_days) <= F.lit(now))
        if not lost.isEmpty():
            raise ValueError("the interval reaches back beyond the retention of the raw rows")
    return _run(spark, raw, mart_root, ledger_root, hours, now, assume_stable_event_time)


def compact_ledger(spark: SparkSession, ledger_root: str) -> None:
    """Rewrite the ledger as one row per hour, the last filling. Runs add a file each."""
    ledger = read_ledger(spark, ledger_root)
    latest = ledger.groupBy("hour_ts").agg(F.max("filled_at").alias("filled_at"))
    storage.replace_table(spark, latest, ledger_root)
