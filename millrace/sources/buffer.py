"""The durable file buffer: date-partitioned Parquet, whole files only."""

from __future__ import annotations

import datetime as dt
import secrets
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas, storage

_LISTING = "file_path STRING, dt STRING, modified_at TIMESTAMP, bytes BIGINT"


def _roots(spark: SparkSession, root: str, since: dt.date | None) -> list[str]:
    if since is not None:
        return [path for path, _ in storage.dated_directories(spark, root, since)]
    return [root] if storage.exists(spark, root) else []


def scan_since(spark: SparkSession, root: str, since: dt.date | None = None) -> DataFrame:
    """Rows of every buffered file, or of partitions dated ``since`` or later.

    Old partitions are left out before their files are even listed. Directories that
    are not dates count only without a bound; files in subdirectories always count.
    """
    roots = _roots(spark, root, since)
    if not roots:
        return spark.createDataFrame([], schemas.with_partition(schemas.RAW_NRT, "dt"))
    rows = spark.read.schema(schemas.RAW_NRT).parquet(
        *roots, recursiveFileLookup=True, pathGlobFilter="*.parquet"
    )
    return rows.withColumn("dt", storage.path_partition(F.col("_metadata.file_path")))


def file_inventory(spark: SparkSession, root: str, since: dt.date | None = None) -> DataFrame:
    """The buffered files themselves: path, partition, modification time, size.

    No content is read, so the bytes don't decide the number of tasks: there is one per
    core, each with its share of the files.
    """
    roots = _roots(spark, root, since)
    if not roots:
        return spark.createDataFrame([], _LISTING)
    listed = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.parquet")
        .load(roots)
        .coalesce(spark.sparkContext.defaultParallelism)
    )
    return listed.select(
        storage.same_path(F.col("path")).alias("file_path"),
        storage.path_partition(F.col("path")).alias("dt"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("bytes"),
    )


def _stand_ins() -> dict[T.DataType, str | int]:
    """What a column reads as in a file that doesn't have it, drawn anew for every read.

    So no stored value is mistaken for it: one that happens to be drawn, of 2^62 numbers or
    as many texts, fails that one read and not its repetition.
    """
    return {T.StringType(): f"absent column {uuid.uuid4().hex}", T.LongType(): -secrets.randbelow(2**62) - 1}


def _marked_schema(stand_ins: dict[T.DataType, str | int]) -> T.StructType:
    """The event columns, those that may be null with a stand-in for "not in the file"."""
    fields = []
    for field in schemas.RAW_NRT.fields:
        marks = {}
        if field.name not in schemas.RAW_NRT_REQUIRED:
            stand_in = stand_ins[field.dataType]
            literal = f"'{stand_in}'" if isinstance(stand_in, str) else f"{stand_in}L"
            marks = {"EXISTS_DEFAULT": literal, "CURRENT_DEFAULT": "NULL"}
        fields.append(T.StructField(field.name, field.dataType, True, marks))
    return T.StructType(fields)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Exactly the event columns of the given files, plus the file each row is from.

    Every file must have all 14 columns, or the read fails with its name. With a declared
    schema Spark fills in what a file does not have: nulls where the event table allows
    none, and elsewhere a stand-in that tells a missing column from a null.
    """
    stand_ins = _stand_ins()
    rows = spark.read.schema(_marked_schema(stand_ins)).parquet(*paths)
    checked = []
    for field in schemas.RAW_NRT.fields:
        name = field.name
        problem = F.raise_error(F.concat(F.lit(f"no {name} in "), F.col("_metadata.file_path")))
        if name in schemas.RAW_NRT_REQUIRED:
            absent = F.col(name).isNull()
        else:
            absent = F.col(name) == F.lit(stand_ins[field.dataType])
        value = F.when(absent, problem.cast(field.dataType)).otherwise(F.col(name))
        checked.append(value.alias(name))
    return rows.select(
        *checked, storage.same_path(F.col("_metadata.file_path")).alias("file_path")
    )


def file_row_counts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows per file. No column is read: the counts come from the file footers."""
    rows = spark.read.schema(schemas.RAW_NRT).parquet(*paths)
    return rows.groupBy(storage.same_path(F.col("_metadata.file_path")).alias("file_path")).agg(
        F.count("*").alias("row_count")
    )
