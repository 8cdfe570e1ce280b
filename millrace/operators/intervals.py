"""Hourly intervals: which exist, which are filled, which are due."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import expires_at, hour_start
from millrace.horizon import is_open


def in_interval(instant: Column, start: Column, end: Column) -> Column:
    """Half-open: an event on a boundary belongs to exactly one interval."""
    return (instant >= start) & (instant < end)


def hours_between(bounds: DataFrame) -> DataFrame:
    """Every full hour from ``first_hour`` up to, not including, ``end_hour``."""
    hours = F.sequence(
        hour_start(F.col("first_hour")),
        hour_start(F.col("end_hour")) - F.expr("interval 1 hour"),
        F.expr("interval 1 hour"),
    )
    return (
        bounds.where(hour_start(F.col("first_hour")) < hour_start(F.col("end_hour")))
        .select(F.explode(hours).alias("hour_ts"))
    )


def missing_intervals(hours: DataFrame, ledger: DataFrame) -> DataFrame:
    """The hours no run has filled yet."""
    return hours.join(ledger.select("hour_ts").distinct(), "hour_ts", "left_anti")


def dirty_intervals(dirty: DataFrame, ledger: DataFrame) -> DataFrame:
    """The hours a run has filled and a load has touched since."""
    return dirty.select("hour_ts").distinct().join(ledger.select("hour_ts"), "hour_ts", "left_semi")


def due_intervals(
    hours: DataFrame,
    ledger: DataFrame,
    now: dt.datetime,
    lookback_hours: int,
    retention_days: int,
    dirty: DataFrame | None = None,
    horizon: dt.datetime | None = None,
) -> DataFrame:
    """Missing hours plus the few before the newest one, as far back as raw rows are kept.

    ``dirty`` adds hours that loads have touched since they were filled. Raw rows past
    retention, and those before ``horizon``, are gone, so recomputing their hours would replace
    good history with nothing.
    """
    this_hour = hour_start(F.lit(now))
    newest = this_hour - F.make_interval(hours=F.lit(1))
    revisited = in_interval(
        F.col("hour_ts"), newest - F.make_interval(hours=F.lit(lookback_hours)), newest
    )
    kept = expires_at(F.col("hour_ts"), retention_days) > F.lit(now)
    due = missing_intervals(hours, ledger).unionByName(hours.where(revisited))
    if dirty is not None:
        due = due.unionByName(dirty_intervals(dirty, ledger).join(hours, "hour_ts", "left_semi"))
    return due.distinct().where(kept & is_open(F.col("hour_ts"), horizon))


def late_event_profile(events: DataFrame, lookback_hours: int) -> DataFrame:
    """Events by how many hours after their own they arrived, and what a run counts.

    Hour ``h`` is computed when it ends and again for ``lookback_hours`` more hours, so
    an event counts if it arrived no more than that many hours later.
    """
    hours_late = (
        F.unix_seconds(hour_start(F.col("arrived_at"))) - F.unix_seconds(hour_start(F.col("event_dt")))
    ) / 3600
    return (
        events.groupBy(hours_late.cast("bigint").alias("hours_late"))
        .agg(F.count("*").alias("events"))
        .select(
            "hours_late",
            "events",
            (F.col("hours_late") <= 0).alias("counted_without_lookback"),
            (F.col("hours_late") <= lookback_hours).alias("counted"),
        )
    )
