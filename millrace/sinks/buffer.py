"""Writers of the landing side: event buffer and quarantine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas, storage


def write_buffer(accepted: DataFrame, root: str) -> None:
    """Add files of flat events, partitioned by UTC event date and by nothing else.

    A date gets one file per write until its rows outgrow the session's advisory
    partition size, then several. Existing files are never touched.
    """
    storage.append_partitioned(accepted.select(*schemas.RAW_NRT.names, "dt"), root, "dt")


def dead_letters(rejected: DataFrame, received_at: dt.datetime) -> DataFrame:
    """``received_at, error, raw_line`` and the UTC date of receipt."""
    moment = F.lit(received_at.astimezone(dt.timezone.utc).isoformat())
    return rejected.select(
        moment.alias("received_at"),
        "error",
        "raw_line",
        F.lit(received_at.astimezone(dt.timezone.utc).date().isoformat()).alias("dt"),
    )


def write_dead_letters(rejected: DataFrame, root: str, received_at: dt.datetime) -> None:
    """Add JSON lines files under the date of receipt.

    One file per write until its lines outgrow the session's advisory partition size.
    """
    letters = dead_letters(rejected, received_at).hint("rebalance", "dt")
    letters.write.mode("append").partitionBy("dt").json(root)


def append_flush(record: DataFrame, root: str) -> None:
    """Add one flush: a row per topic partition."""
    record.select(*schemas.FLUSHES.names).coalesce(1).write.mode("append").parquet(root)


def read_flushes(spark: SparkSession, root: str) -> DataFrame:
    return storage.read_table(spark, root, schemas.FLUSHES)
