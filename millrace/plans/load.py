"""Idempotent incremental load: buffered files into the raw event table, each once."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace import schemas, storage
from millrace.functions.dates import hour_start
from millrace.horizon import split
from millrace.operators import files
from millrace.operators.deliveries import touched_hours
from millrace.sinks.tables import append_manifest, append_raw_nrt, to_table_precision, write_expired
from millrace.sources.buffer import file_inventory, file_row_counts, read_files


@dataclass(frozen=True)
class LoadResult:
    files_loaded: int
    rows_loaded: int


def read_manifest(spark: SparkSession, root: str, since: dt.date | None = None) -> DataFrame:
    """Recorded files; with ``since`` only those whose path date is not older."""
    manifest = storage.read_table(spark, root, schemas.MANIFEST, "dt")
    return manifest if since is None else manifest.where(F.col("dt") >= since.isoformat())


def pending_files(
    spark: SparkSession, buffer_root: str, manifest_root: str, since: dt.date | None = None
) -> DataFrame:
    """Buffered files without a manifest row, looking only at dates from ``since`` on.

    Both sides are cut by the date in the path, never by the time of loading, so a file
    loaded long ago or dated ahead is still recognised.
    """
    listed = file_inventory(spark, buffer_root, since)
    return files.new_files(listed, read_manifest(spark, manifest_root, since))


def _chunks(paths: Iterator[str], size: int) -> Iterator[list[str]]:
    while chunk := list(islice(paths, size)):
        yield chunk


def load_id_of(paths: Iterable[str]) -> str:
    """The same files give the same id, in whatever order."""
    return "load-" + hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:24]


class PlannedLoads:
    """The files of loads that were begun, each in a directory of its own until it is done.

    A load is planned before anything else is written. One that died is run again with the very
    same files, and so replaces what it had written, before new files are looked for.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def add(self, load_id: str, paths: list[str]) -> None:
        listed = self.spark.createDataFrame([(path,) for path in paths], schemas.PLANNED_FILES)
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{load_id}")

    def remove(self, load_id: str) -> None:
        storage.delete(self.spark, f"{self.root}/{load_id}")

    def unfinished(self) -> Iterator[tuple[str, list[str]]]:
        """Plans that were written completely; of any other nothing else was written either."""
        for load_id in storage.subdirectories(self.spark, self.root):
            if storage.exists(self.spark, f"{self.root}/{load_id}/_SUCCESS"):
                rows = self.spark.read.schema(schemas.PLANNED_FILES).parquet(f"{self.root}/{load_id}")
                yield load_id, [row["file_path"] for row in rows.collect()]  # a job's files, bounded
            else:
                self.remove(load_id)

    def files(self) -> DataFrame:
        """All planned files."""
        names = storage.subdirectories(self.spark, self.root)
        if not names:
            return self.spark.createDataFrame([], schemas.PLANNED_FILES)
        return self.spark.read.schema(schemas.PLANNED_FILES).parquet(*(f"{self.root}/{n}" for n in names))


def planned_loads(spark: SparkSession, manifest_root: str, planned_root: str | None = None) -> PlannedLoads:
    """By default they lie beside the manifest."""
    return PlannedLoads(spark, planned_root or f"{manifest_root.rstrip('/')}_planned")


def load_new_files(
    spark: SparkSession,
    buffer_root: str,
    raw_root: str,
    manifest_root: str,
    now: dt.datetime,
    since: dt.date | None = None,
    files_per_job: int = 10_000,
    planned_root: str | None = None,
    dirty_root: str | None = None,
    horizon: dt.datetime | None = None,
    expired_root: str | None = None,
    events_move: bool = True,
) -> LoadResult:
    """Load what the manifest does not list yet, then list it.

    The plan first, then data, then the manifest: a load that died in between is repeated with
    the same files and replaces what it had written, so that raw rows and manifest are those of
    one load. Paths are handed to the reader a bounded number at a time; the rows never leave
    the executors.

    ``dirty_root`` gets the hours whose mart rows the load may change. If ``events_move``, these
    are also the hours of earlier deliveries of the same events, at the price of a look at the
    raw table's ids. Deliveries older than ``horizon`` go to ``expired_root`` instead of the raw
    table; without one they are counted in the manifest only.
    """
    planned = planned_loads(spark, manifest_root, planned_root)
    files_loaded = rows_loaded = 0

    def load(load_id: str, paths: list[str], again: bool) -> None:
        nonlocal files_loaded, rows_loaded
        inside, late = split(to_table_precision(read_files(spark, paths).drop("file_path")), horizon)
        append_raw_nrt(inside, raw_root, load_id)
        if horizon is not None and expired_root is not None:
            write_expired(late, expired_root, load_id)
        if dirty_root is not None:
            mark_dirty_hours(spark, raw_root, dirty_root, load_id, now, events_move)
        totals = Observation()
        listed = spark.createDataFrame([(path,) for path in paths], schemas.PLANNED_FILES)
        recorded = files.manifest_rows(listed, file_row_counts(spark, paths), now)
        if again:  # it may have died while the manifest was written
            recorded = files.new_files(recorded, read_manifest(spark, manifest_root))
        append_manifest(
            recorded.observe(totals, F.sum("row_count").alias("rows")), manifest_root
        )
        planned.remove(load_id)
        files_loaded += len(paths)
        rows_loaded += storage.observed(totals, "rows")

    for load_id, paths in planned.unfinished():
        load(load_id, paths, again=True)
    waiting = pending_files(spark, buffer_root, manifest_root, since).select("file_path")
    paths = (row["file_path"] for row in waiting.toLocalIterator(prefetchPartitions=True))
    for chunk in _chunks(paths, files_per_job):
        load_id = load_id_of(chunk)
        planned.add(load_id, chunk)
        load(load_id, chunk, again=False)
    return LoadResult(files_loaded, rows_loaded)


def mark_dirty_hours(
    spark: SparkSession, raw_root: str, dirty_root: str, load_id: str, now: dt.datetime, events_move: bool = True
) -> None:
    """Record the hours a load's rows may change, in a directory of the load's own."""
    loaded = read_load(spark, raw_root, load_id)
    if events_move:
        hours = touched_hours(read_raw_nrt(spark, raw_root), loaded)
    else:
        hours = loaded.select(hour_start(F.col("event_dt")).alias("hour_ts")).distinct()
    marks = hours.withColumn("dirtied_at", F.lit(now).cast("timestamp"))
    # Hours of the calendar: one small file.
    marks.coalesce(1).write.mode("overwrite").parquet(f"{dirty_root.rstrip('/')}/{load_id}")


def read_raw_nrt(spark: SparkSession, raw_root: str) -> DataFrame:
    """The raw event table with its partition column ``dt``."""
    return _raw_with_load(spark, raw_root).drop("load")


def read_load(spark: SparkSession, raw_root: str, load_id: str) -> DataFrame:
    """The rows one load has put into the raw table; no other file is opened."""
    return _raw_with_load(spark, raw_root).where(F.col("load") == load_id).drop("load")


def _raw_with_load(spark: SparkSession, raw_root: str) -> DataFrame:
    return storage.read_table(spark, raw_root, schemas.with_partition(schemas.RAW_NRT, "dt"), "load")


def delete_loaded_files(
    spark: SparkSession,
    buffer_root: str,
    manifest_root: str,
    now: dt.datetime,
    retention_days: int = 1,
    since: dt.date | None = None,
    planned_root: str | None = None,
) -> int:
    """Remove buffered files that are both loaded and past retention; how many.

    The files of a load that has not ended stay, as it may have to read them again.

    A directory all of whose files may go is removed in one call, if it still holds no
    more files than were listed; files of other directories go one by one.
    """
    listed = file_inventory(spark, buffer_root, since)
    expired = files.cleanup_candidates(
        listed, read_manifest(spark, manifest_root, since), now, retention_days
    ).select("file_path", F.lit(True).alias("goes"))
    expired = files.new_files(expired, planned_loads(spark, manifest_root, planned_root).files())
    folder = F.regexp_extract("file_path", r"^(.*)/[^/]+$", 1).alias("folder")
    judged = (
        listed.select("file_path")
        .join(expired, "file_path", "left")
        .select(folder, "file_path", F.coalesce("goes", F.lit(False)).alias("goes"))
    )
    judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        # One row per directory.
        state = judged.groupBy("folder").agg(
            F.count("*").alias("files"), F.count_if("goes").alias("going")
        )
        deleted, partly = 0, []
        for row in state.where("going > 0").toLocalIterator():
            whole = row["files"] == row["going"] == storage.count_below(spark, row["folder"])
            if whole:
                storage.delete(spark, row["folder"])
                deleted += row["going"]
            else:
                partly.append(row["folder"])
        if partly:
            rest = judged.where(F.col("goes") & F.col("folder").isin(partly))
            for row in rest.select("file_path").toLocalIterator():
                deleted += storage.delete(spark, row["file_path"])
        return deleted
    finally:
        judged.unpersist()
