"""Data-quality checks as ordinary tables of ``check, passed, value, threshold``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import age_seconds
from millrace.operators import files, offsets

# The most files that may wait, and the most messages behind.
MAX_BACKLOG_FILES = 200
MAX_CONSUMER_LAG = 5000


def _at_most(check: str, value: Column, threshold: int) -> list[Column]:
    value = F.coalesce(value, F.lit(0)).cast("bigint")
    return [
        F.lit(check).alias("check"),
        (value <= threshold).alias("passed"),
        value.alias("value"),
        F.lit(threshold).cast("bigint").alias("threshold"),
    ]


def backlog_check(
    listed: DataFrame, manifest: DataFrame, max_files: int = MAX_BACKLOG_FILES
) -> DataFrame:
    """Files landed but not loaded, over the whole history."""
    waiting = files.new_files(listed, manifest).agg(F.count("*").alias("n"))
    return waiting.select(*_at_most("backlog_files", F.col("n"), max_files))


def lag_check(
    committed: DataFrame, watermarks: DataFrame, max_lag: int = MAX_CONSUMER_LAG
) -> DataFrame:
    """Messages the topic holds that no flush has committed, over all partitions."""
    total = offsets.partition_lag(committed, watermarks).agg(F.sum("lag").alias("n"))
    return total.select(*_at_most("consumer_lag", F.col("n"), max_lag))


def audit_check(mart: DataFrame) -> DataFrame:
    """No row of the mart may lack its wiki."""
    bad = F.count_if(F.col("wiki").isNull() | (F.col("wiki") == ""))
    return mart.agg(bad.alias("n")).select(*_at_most("not_null_wiki", F.col("n"), 0))


def raw_batch_state(raw_batch: DataFrame) -> DataFrame:
    """Time of the last fetch and number of rows; null and 0 for an empty table."""
    return raw_batch.agg(
        F.max("fetched_at").alias("max_fetched_at"), F.count("*").alias("row_count")
    )


def raw_batch_freshness(raw_batch: DataFrame, last_seen: dt.datetime | None) -> DataFrame:
    """The table's state with ``empty``, ``unchanged`` or ``changed`` since ``last_seen``."""
    seen = F.lit(last_seen).cast("timestamp")
    latest = F.col("max_fetched_at")
    status = (
        F.when(latest.isNull(), "empty")
        .when(latest.eqNullSafe(seen), "unchanged")
        .otherwise("changed")
    )
    return raw_batch_state(raw_batch).withColumn("status", status)


def source_freshness(arrivals: DataFrame, now: dt.datetime | Column) -> DataFrame:
    """Seconds since each source last delivered. A source that never did has no row."""
    moment = now if isinstance(now, Column) else F.lit(now)
    latest = arrivals.groupBy("source").agg(F.max("arrived_at").alias("last_arrival"))
    return latest.withColumn("age_seconds", age_seconds(F.col("last_arrival"), moment))


def grain_violations(rows: DataFrame, grain: list[str]) -> DataFrame:
    """Keys more than one row has, with how many."""
    return rows.groupBy(*grain).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
