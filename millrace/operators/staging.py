"""The staging layer: same grain as raw, deduplicated and narrowed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace import schemas

# Ties in time are broken by the columns a row shows, in this order. The hourly mart
# needs only the first three, so it can sort by that prefix and read nothing else:
# the winner's values in those columns are the same either way.
_TIE_BREAK = ["wiki", "user", "bot"]


def latest_delivery(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per ``event_id``: the one with the latest ``event_dt``.

    Spark keeps one row per id and task before the shuffle (a group limit), so an
    event redelivered any number of times costs its receiver one row per task.
    """
    shown = [c for c in columns if c not in ("event_id", "event_dt")]
    ties = [c for c in _TIE_BREAK if c in shown] + [c for c in shown if c not in _TIE_BREAK]
    newest = W.partitionBy("event_id").orderBy(F.desc("event_dt"), *ties)
    return (
        raw.select(*columns)
        .withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") == 1)
        .drop("rn")
    )


def stg_events_nrt(raw: DataFrame) -> DataFrame:
    """Deduplicated events without the before-values and the payload."""
    return latest_delivery(raw, schemas.STG_EVENTS)


def events_for_interval(
    raw: DataFrame, start: Column, end: Column, columns: Sequence[str]
) -> DataFrame:
    """Deduplicated events with ``start <= event_dt < end``, reading only what can matter.

    The latest delivery decides, so one before ``start`` can neither be in the interval
    nor displace one that is: it is dropped below the window, where the filter reaches
    the scan. Deliveries after ``end`` stay in, as they do displace earlier ones. The
    result equals filtering the whole deduplicated view.
    """
    reachable = raw.where(F.col("event_dt") >= start)
    if "dt" in raw.columns:
        reachable = reachable.where(F.col("dt") >= F.date_format(start, "yyyy-MM-dd"))
    return latest_delivery(reachable, columns).where(F.col("event_dt") < end)


def stg_events_batch(raw_batch: DataFrame) -> DataFrame:
    """The article rows as they are."""
    return raw_batch.select(*schemas.RAW_BATCH.names)


def drifting_events(raw: DataFrame) -> DataFrame:
    """Ids whose deliveries disagree on the time of the event."""
    return (
        raw.groupBy("event_id")
        .agg(F.min("event_dt").alias("earliest"), F.max("event_dt").alias("latest"))
        .where(F.col("earliest") != F.col("latest"))
    )
