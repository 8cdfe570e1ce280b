"""File-system steps Spark's readers and writers do not offer.

Everything goes through Hadoop's FileSystem, so paths may live on any store
the session can reach. Only directory names and single paths pass through the
driver here, never data.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DATED_DIR = re.compile(r"dt=(\d{4}-\d{2}-\d{2})")


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> bool:
    """Remove one file, or one directory with what it holds."""
    fs, target = _resolve(spark, path)
    return fs.delete(target, True)


def make_directory(spark: SparkSession, path: str) -> None:
    """A directory and those above it; nothing where it exists."""
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def subdirectories(spark: SparkSession, root: str) -> list[str]:
    """Names of the directories directly below ``root``; none if it is missing."""
    fs, target = _resolve(spark, root)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def file_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the files directly below ``root``, hidden ones left out; none if it is missing."""
    fs, target = _resolve(spark, root)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target) if s.isFile()]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def read_text(spark: SparkSession, path: str) -> str:
    """A file of one short line."""
    fs, target = _resolve(spark, path)
    stream = fs.open(target)
    try:
        return stream.readLine()
    finally:
        stream.close()


def publish_text(spark: SparkSession, text: str, path: str) -> bool:
    """Put one short line at ``path``, whole or not at all; False if something is there already.

    Written aside and renamed without overwriting: of several writers one succeeds, on stores
    whose rename is atomic (a local disk, HDFS).
    """
    fs, target = _resolve(spark, path)
    jvm = spark._jvm
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    stream = fs.create(aside)
    stream.writeBytes(text)
    stream.close()
    if fs.exists(target):
        fs.delete(aside, False)
        return False
    return _renamed(spark, fs, aside, target)


def _renamed(spark: SparkSession, fs, source, target) -> bool:
    """Rename without overwriting; where another writer came first, remove ``source``."""
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), fs.getConf())
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    never = spark.sparkContext._gateway.new_array(options, 1)
    never[0] = options.NONE
    try:
        context.rename(fs.makeQualified(source), fs.makeQualified(target), never)
        return True
    except Py4JJavaError as error:
        fs.delete(source, False)
        if error.java_exception.getClass().getName().endswith("FileAlreadyExistsException"):
            return False
        raise


def count_below(spark: SparkSession, root: str) -> int:
    """Files and directories directly below ``root``, Spark's own marks left out."""
    fs, target = _resolve(spark, root)
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sum(not name.startswith(("_", ".")) for name in names)


def partition_date(name: str) -> dt.date | None:
    """The date in a ``dt=YYYY-MM-DD`` directory name, or None for any other name."""
    match = _DATED_DIR.fullmatch(name)
    if match is None:
        return None
    try:
        return dt.date.fromisoformat(match.group(1))
    except ValueError:
        return None


def dated_directories(
    spark: SparkSession, root: str, since: dt.date | None = None
) -> list[tuple[str, dt.date]]:
    """``(path, date)`` of the dated partitions of ``root``, from ``since`` on.

    One listing of one directory: older partitions are never opened.
    """
    found = ((name, partition_date(name)) for name in subdirectories(spark, root))
    return [
        (f"{root.rstrip('/')}/{name}", day)
        for name, day in found
        if day is not None and (since is None or day >= since)
    ]


def same_path(path: Column) -> Column:
    """One spelling for local paths: ``file:///a`` and ``file:/a`` name the same file."""
    return F.regexp_replace(path, r"^file:/+", "file:/")


def path_partition(path: Column) -> Column:
    """The value of the ``dt=`` directory in a file path, or an empty string."""
    return F.regexp_extract(path, r"/dt=([^/]+)/", 1)


def read_table(
    spark: SparkSession, root: str, schema: T.StructType, partition: str | None = None
) -> DataFrame:
    """A Parquet table with its declared schema; empty while the root is missing or bare."""
    full = (
        schema
        if partition is None
        else T.StructType(schema.fields + [T.StructField(partition, T.StringType())])
    )
    if not exists(spark, root):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).parquet(root)


def append_partitioned(
    rows: DataFrame, root: str, partition: str, sort: Iterable[str] = ()
) -> None:
    """Append to a Parquet table, a few right-sized files per partition value.

    REBALANCE lets adaptive execution cut a partition value that holds most of
    the rows into several tasks and merge the small ones, so neither one hot day
    nor many near-empty days decide the file layout.
    """
    (
        rows.hint("rebalance", partition)
        .sortWithinPartitions(partition, *sort)
        .write.mode("append")
        .partitionBy(partition)
        .parquet(root)
    )


def replace_partitions(
    rows: DataFrame, root: str, partitions: list[str], sort: Iterable[str] = ()
) -> None:
    """Write rows so that the partitions they fall into hold nothing else.

    The same rows written again change nothing. Files are sized as in :func:`append_partitioned`.
    """
    (
        rows.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, *sort)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(root)
    )


def observed(totals: Observation, name: str) -> int:
    """A total observed during a write.

    Where the optimizer can prove there are no rows it drops the observation with them.
    """
    try:
        return totals.get[name] or 0
    except Py4JJavaError:
        return 0


def replace_table(spark: SparkSession, rows: DataFrame, root: str) -> None:
    """Put ``rows``, which may be read from ``root`` itself, in place of a table's files.

    The new files lie beside the old ones before those go; in between both are there, so a
    table kept this way must not mind repeated rows.
    """
    if not exists(spark, root):
        return
    fs, target = _resolve(spark, root)
    old = [s.getPath() for s in fs.listStatus(target) if s.getPath().getName().endswith(".parquet")]
    rows.select(*rows.columns).hint("rebalance").write.mode("append").parquet(root)
    for path in old:
        fs.delete(path, False)
