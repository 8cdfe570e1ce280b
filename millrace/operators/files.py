"""Relations over file listings: what is new, what may go, how to batch it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import age_seconds
from millrace.operators.numbering import numbered


def loaded_since(manifest: DataFrame, since: dt.datetime | None = None) -> DataFrame:
    """Manifest rows of loads at or after ``since``."""
    return manifest if since is None else manifest.where(F.col("loaded_at") >= F.lit(since))


def new_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files no load has recorded."""
    return files.join(manifest.select("file_path"), "file_path", "left_anti")


def cleanup_candidates(
    files: DataFrame, manifest: DataFrame, now: dt.datetime, retention_days: int = 1
) -> DataFrame:
    """Files past retention that a load has recorded. Unloaded files are never offered."""
    old = files.where(
        age_seconds(F.col("modified_at"), F.lit(now)) >= F.lit(retention_days * 86_400)
    )
    return old.join(manifest.select("file_path"), "file_path", "left_semi")


def observed_files(current: DataFrame, seen: DataFrame) -> DataFrame:
    """Paths of the current listing, each marked new or already seen.

    Seen paths that have left the listing fall out, so the remembered set never grows
    past what is there.
    """
    cursor = seen.select("file_path").distinct().withColumn("is_new", F.lit(False))
    paths = current.select("file_path").distinct()
    return paths.join(cursor, "file_path", "left").select(
        "file_path", F.coalesce("is_new", F.lit(True)).alias("is_new")
    )


def load_batches(files: DataFrame, batch_size: int = 40) -> DataFrame:
    """Files in path order with the number of the load batch each belongs to."""
    in_order = numbered(files.select("file_path"), [], ["file_path"], "position")
    batch = F.floor((F.col("position") - 1) / batch_size).cast("bigint")
    return in_order.select("file_path", batch.alias("batch_no"))


def manifest_rows(files: DataFrame, counts: DataFrame, loaded_at: dt.datetime) -> DataFrame:
    """One manifest row per file, also for files without rows."""
    return files.select("file_path").join(counts, "file_path", "left").select(
        "file_path",
        F.lit(loaded_at).cast("timestamp").alias("loaded_at"),
        F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
    )
