"""Reading the given tables, and intermediate tables in the shared folder."""

from __future__ import annotations

import os
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import work_dir

#: Rows that cross into Python at once. Texts may be long, so that few are held together.
ROWS_PER_BATCH = 1000
#: And so many bytes, where rows are blocks of numbers.
BYTES_PER_BATCH = 1 << 23
#: Row groups of stored tables whose rows are that large. Their writer holds one, and their reader
#: unpacks up to one at a time.
SMALL_GROUPS = {
    "parquet.block.size": 1 << 23,
    "parquet.block.size.row.check.min": 1,
    "parquet.page.size.row.check.min": 1,
}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Keep the batches that cross into Python small, and let its workers find this package.

    On a cluster the package is installed or shipped with ``--py-files``; where it is only a
    folder, all see that folder.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    home = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if home not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, known]))


def stored(frame: DataFrame, label: str, large_rows: bool = False) -> DataFrame:
    """``frame`` written once to the shared folder and read back.

    Cuts the lineage, so that what follows may be evaluated several times and a lost
    executor costs a read, not a recomputation. ``large_rows`` tells of rows of many KB, which
    are kept in small row groups.
    """
    spark = frame.sparkSession
    path = work_dir(spark, label)
    frame.write.options(compression="zstd", **(SMALL_GROUPS if large_rows else {})).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Keys that are sent to every task; more of them are joined by a shuffle of both sides.
BROADCAST_KEYS = 1 << 18


def keyed(frame: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``frame`` semi- or anti-joined with stored ``keys`` by their columns; null equals null.

    Key columns are named as in ``frame``. Few keys, by a count, go to every task, so that the
    frame's texts stay where they are; of more, both sides are shuffled once.
    """
    few = keys.count() <= BROADCAST_KEYS
    named = keys.select(*(F.col(c).alias(f"__key_{c}") for c in keys.columns))
    same = [frame[c].eqNullSafe(F.col(f"__key_{c}")) for c in keys.columns]
    return frame.join(F.broadcast(named) if few else named, reduce(Column.__and__, same), how)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal digits, modulo ``parts``: decides what is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts
