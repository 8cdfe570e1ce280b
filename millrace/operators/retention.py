"""What has outlived its keeping, and how it is removed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import storage
from millrace.functions.dates import expires_at


def is_retained(instant: Column, now: dt.datetime, days: int = 5) -> Column:
    return expires_at(instant, days) > F.lit(now)


def ttl_retained(rows: DataFrame, instant: str, now: dt.datetime, days: int = 5) -> DataFrame:
    """Rows whose day is at most ``days`` days old."""
    return rows.where(is_retained(F.col(instant), now, days))


def drop_expired_days(
    spark: SparkSession, root: str, now: dt.datetime, days: int = 5
) -> list[dt.date]:
    """Remove whole ``dt=`` partitions past retention. No row is read or rewritten."""
    expired = []
    for path, day in storage.dated_directories(spark, root):
        if dt.datetime.combine(day, dt.time(), now.tzinfo) + dt.timedelta(days=days) <= now:
            storage.delete(spark, path)
            expired.append(day)
    return expired


def rewrite_retained(
    spark: SparkSession, root: str, schema: T.StructType, partition: str, keep: Column
) -> None:
    """Drop the rows that fail ``keep`` where a partition holds more than one day.

    Only partitions with something to drop are rewritten; those left empty are removed.
    """
    table = storage.read_table(spark, root, schema, partition)
    # One row per partition: months or load days, a short list.
    state = table.groupBy(partition).agg(
        F.count_if(keep).alias("kept"), F.count_if(~keep).alias("expired")
    )
    touched = [row for row in state.toLocalIterator() if row["expired"]]
    partial = [row[partition] for row in touched if row["kept"]]
    if partial:
        (
            table.where(F.col(partition).isin(partial) & keep)
            .hint("rebalance", partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(root)
        )
    for row in touched:
        if not row["kept"]:
            storage.delete(spark, f"{root.rstrip('/')}/{partition}={row[partition]}")


def compact_partitions(
    spark: SparkSession, root: str, schema: T.StructType, partition: str, max_files: int = 16
) -> list[str]:
    """Rewrite partitions of more than ``max_files`` files as a few; which ones.

    For tables every run adds a small file to, like the manifest.
    """
    table = storage.read_table(spark, root, schema, partition)
    if not storage.exists(spark, root):
        return []
    files = (
        table.select(partition, F.col("_metadata.file_path").alias("file"))
        .distinct()
        .groupBy(partition)
        .agg(F.count("*").alias("files"))
    )
    crowded = [row[partition] for row in files.where(F.col("files") > max_files).toLocalIterator()]
    if crowded:
        (
            table.where(F.col(partition).isin(crowded))
            .hint("rebalance", partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(partition)
            .parquet(root)
        )
    return crowded
