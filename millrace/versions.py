"""Partitioned tables that change by whole partitions and remember what they were before.

A partition value has one directory per version that touched it. A writer reads the state before
its own version, so that repeating a version after a crash gives the same result; readers see a
version only once it is committed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import storage

_VERSION = "v"
_COMMITTED = "_committed"


class VersionedTable:
    """``schema`` without the partition column, which is a string.

    Versions are integers that grow. Directory names pass through the driver, one per partition
    value; rows never do.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition: str):
        self.spark, self.root, self.schema, self.partition = spark, root.rstrip("/"), schema, partition

    def committed(self) -> int | None:
        """The last version that was written completely."""
        marks = storage.subdirectories(self.spark, f"{self.root}/{_COMMITTED}")
        return max(map(int, marks), default=None)

    def commit(self, version: int) -> None:
        storage.make_directory(self.spark, f"{self.root}/{_COMMITTED}/{version}")
        for mark in storage.subdirectories(self.spark, f"{self.root}/{_COMMITTED}"):
            if int(mark) < version:
                storage.delete(self.spark, f"{self.root}/{_COMMITTED}/{mark}")

    def _versions(self, values: Iterable[str] | None) -> dict[str, list[int]]:
        prefix = f"{self.partition}="
        if values is None:
            names = storage.subdirectories(self.spark, self.root)
            values = [name.removeprefix(prefix) for name in names if name.startswith(prefix)]
        found = {}
        for value in values:
            marks = storage.subdirectories(self.spark, f"{self.root}/{prefix}{value}")
            found[value] = sorted(int(m.removeprefix(f"{_VERSION}=")) for m in marks if m.startswith(f"{_VERSION}="))
        return found

    def _directory(self, value: str, version: int) -> str:
        return f"{self.root}/{self.partition}={value}/{_VERSION}={version}"

    def read(self, before: int | None = None, values: Iterable[str] | None = None) -> DataFrame:
        """The rows of the last committed version, or as they were before a version.

        With ``values`` only those partitions are listed and read.
        """
        last = self.committed() if before is None else before - 1
        paths = []
        if last is not None:
            for value, versions in self._versions(values).items():
                seen = [version for version in versions if version <= last]
                paths += [self._directory(value, version) for version in seen[-1:]]
        full = T.StructType([*self.schema.fields, T.StructField(self.partition, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], full)
        with_version = T.StructType([*full.fields, T.StructField(_VERSION, T.LongType())])
        return self.spark.read.schema(with_version).option("basePath", self.root).parquet(*paths).drop(_VERSION)

    def write(self, rows: DataFrame, version: int, values: Iterable[str], sort: Iterable[str] = ()) -> None:
        """Put ``rows`` in place of the partitions ``values`` as of ``version``.

        A partition of ``values`` without any row is empty from this version on. Running a
        version again replaces what it wrote.
        """
        columns = [*self.schema.names, self.partition]
        (
            rows.select(*columns)
            .withColumn(_VERSION, F.lit(version))
            .hint("rebalance", self.partition)
            .sortWithinPartitions(self.partition, *sort)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.partition, _VERSION)
            .parquet(self.root)
        )
        for value in values:
            storage.make_directory(self.spark, self._directory(value, version))

    def forget(self, before: int) -> None:
        """Remove what no reader of a version from ``before`` on needs any more."""
        for value, versions in self._versions(None).items():
            for version in [v for v in versions if v < before][:-1]:
                storage.delete(self.spark, self._directory(value, version))

    def drop_partitions(self, below: str) -> list[str]:
        """Remove whole partitions whose value sorts before ``below``; which ones."""
        prefix = f"{self.partition}="
        names = [n.removeprefix(prefix) for n in storage.subdirectories(self.spark, self.root) if n.startswith(prefix)]
        gone = [value for value in names if value < below]
        for value in gone:
            storage.delete(self.spark, f"{self.root}/{prefix}{value}")
        return gone
