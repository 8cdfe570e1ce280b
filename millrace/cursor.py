"""What an observer has seen, stored so that every file and every change is reported once.

A cursor is a small table replaced as a whole. Each version has a mark, and a mark can be set
only once: of two runs that read the same version one gets to replace it, and the other has to
look again from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace import schemas, storage
from millrace.operators.files import observed_files
from millrace.plans.quality import raw_batch_state

# Versions kept for runs that are still reading them.
_KEPT = 3


class StoredCursor:
    """Rows of ``schema`` below ``root``, replaced only from the version that was read.

    Only names of versions pass through the driver.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def version(self) -> int:
        """The newest version; 0 before the first."""
        return max(map(int, storage.file_names(self.spark, f"{self.root}/marks")), default=0)

    def read(self, version: int) -> DataFrame:
        """The rows of a version; none in version 0."""
        if version == 0:
            return self.spark.createDataFrame([], self.schema)
        folder = storage.read_text(self.spark, f"{self.root}/marks/{version}")
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/data/{folder}")

    def replace(self, rows: DataFrame, read: int) -> int | None:
        """Put ``rows`` in place of version ``read``; the new version.

        None if another run has replaced it already: nothing has changed then.
        """
        folder, version = uuid.uuid4().hex, read + 1
        path = f"{self.root}/data/{folder}"
        rows.select(*self.schema.names).hint("rebalance").write.parquet(path)
        mark = f"{self.root}/marks/{version}"
        won = storage.publish_text(self.spark, folder, mark)
        if won and self.version() > version:  # the mark was free only because it is long past
            storage.delete(self.spark, mark)
            won = False
        if not won:
            storage.delete(self.spark, path)
            return None
        self._forget(version - _KEPT)
        return version

    def _forget(self, last: int) -> None:
        for name in storage.file_names(self.spark, f"{self.root}/marks"):
            if int(name) <= last:
                mark = f"{self.root}/marks/{name}"
                folder = storage.read_text(self.spark, mark)
                storage.delete(self.spark, mark)
                storage.delete(self.spark, f"{self.root}/data/{folder}")


def report_new_files(spark: SparkSession, listing: DataFrame, root: str) -> DataFrame:
    """Paths of ``listing`` that no run on the cursor at ``root`` has reported yet.

    The cursor holds the paths of the last listing and which of them were new then, so that a
    run that died after replacing it finds its report there (:func:`last_report`). Paths that
    leave the listing are forgotten, and reported again should they come back.
    """
    cursor = StoredCursor(spark, root, schemas.SEEN_FILES)
    while True:
        read = cursor.version()
        version = cursor.replace(observed_files(listing, cursor.read(read)), read)
        if version is not None:
            return _reported(cursor, version)


def last_report(spark: SparkSession, root: str) -> DataFrame:
    """What the last run of :func:`report_new_files` has reported."""
    cursor = StoredCursor(spark, root, schemas.SEEN_FILES)
    return _reported(cursor, cursor.version())


def _reported(cursor: StoredCursor, version: int) -> DataFrame:
    return cursor.read(version).where("is_new").select("file_path")


def report_change(spark: SparkSession, raw_batch: DataFrame, root: str) -> DataFrame:
    """The state of the article table if it is another than the last one reported; else no row.

    An empty table is no change. One row, whatever the table's size.
    """
    cursor = StoredCursor(spark, root, schemas.SEEN_STATE)
    state = raw_batch_state(raw_batch).collect()  # one row
    now = spark.createDataFrame(state, schemas.SEEN_STATE)
    while True:
        read = cursor.version()
        last = cursor.read(read).first()
        if state[0]["max_fetched_at"] in (None, last and last["max_fetched_at"]):
            return now.limit(0)
        version = cursor.replace(now, read)
        if version is not None:
            return cursor.read(version)
