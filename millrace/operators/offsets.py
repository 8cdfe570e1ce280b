"""Offset arithmetic over topic partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_offsets(seen: DataFrame) -> DataFrame:
    """The offset to commit per partition: one past the highest seen, in any order."""
    return seen.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).cast("bigint").alias("next_offset")
    )


def flush_record(judged: DataFrame, flush_id: int | None, flushed_at: dt.datetime) -> DataFrame:
    """What one flush did, per topic partition: next offset, accepted and rejected records."""
    return judged.groupBy("topic", "partition").agg(
        F.lit(flush_id).cast("bigint").alias("flush_id"),
        F.lit(flushed_at).cast("timestamp").alias("flushed_at"),
        (F.max("offset") + 1).cast("bigint").alias("next_offset"),
        F.count_if(F.col("error") == "").alias("accepted"),
        F.count_if(F.col("error") != "").alias("rejected"),
    )


def _once(flushes: DataFrame) -> DataFrame:
    """Flushes repeated after a crash counted once."""
    return flushes.dropDuplicates(["flush_id", "topic", "partition"])


def landed_offsets(flushes: DataFrame) -> DataFrame:
    """The next offset per partition after all flushes."""
    return flushes.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def committed_by(flushes: DataFrame) -> DataFrame:
    """The flushes as the committed side of :func:`consumer_lag`."""
    return landed_offsets(flushes).withColumnRenamed("next_offset", "committed")


def flush_tallies(flushes: DataFrame) -> DataFrame:
    """Accepted and rejected records over all flushes."""
    return _once(flushes).agg(
        F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"),
    )


def partition_lag(committed: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Lag per committed partition. With nothing committed yet the whole log is backlog."""
    position = F.when(F.col("committed") >= 0, F.col("committed")).otherwise(F.col("low"))
    return committed.join(watermarks, ["topic", "partition"], "left").select(
        "topic", "partition", (F.col("high") - position).cast("bigint").alias("lag")
    )


def consumer_lag(committed: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Lag per partition, and per topic in the rows without a partition."""
    return (
        partition_lag(committed, watermarks)
        .rollup("topic", "partition")
        .agg(F.sum("lag").alias("lag"))
        .where(F.col("topic").isNotNull())
    )
