"""Streaming variants of load, deduplication and the hourly mart."""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace import schemas, storage
from millrace.functions.dates import day_label
from millrace.horizon import read_horizon, split
from millrace.operators import deliveries
from millrace.plans.load import read_raw_nrt
from millrace.plans.marts import put_hours
from millrace.session import work_dir
from millrace.sinks.tables import append_raw_nrt, to_table_precision, write_expired
from millrace.versions import VersionedTable


def buffer_stream(
    spark: SparkSession, buffer_root: str, max_files_per_batch: int = 10_000
) -> DataFrame:
    """New buffer files as they appear. The stream's checkpoint is its manifest."""
    return (
        spark.readStream.schema(schemas.RAW_NRT)
        .options(
            recursiveFileLookup=True,
            pathGlobFilter="*.parquet",
            maxFilesPerTrigger=max_files_per_batch,
        )
        .parquet(buffer_root)
    )


def load_stream(events: DataFrame, raw_root: str, checkpoint: str) -> DataStreamWriter:
    """Append every new file's events to the raw table."""

    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:8]

    def append(batch: DataFrame, batch_id: int) -> None:
        append_raw_nrt(batch, raw_root, f"stream-{stream}-{batch_id}")

    return events.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)


class MartState:
    """What the hourly mart is kept up to date from: the newest delivery of every event, and
    edits per wiki, hour and editor. A batch reads the buckets and days it touches, no raw rows.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = deliveries.BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.current = VersionedTable(spark, f"{root}/current", schemas.CURRENT, "bucket")
        self.editor_hours = VersionedTable(spark, f"{root}/editor_hours", schemas.EDITOR_HOURS, "dt")

    def started(self) -> bool:
        return self.current.committed() is not None

    def commit(self, version: int) -> None:
        self.editor_hours.commit(version)
        self.current.commit(version)

    def start_from(self, raw: DataFrame, mart_root: str, horizon: dt.datetime | None) -> None:
        """Build the state, and the mart of all open hours, from a raw table that is there already."""
        newest = deliveries.newest(split(raw, horizon)[0], self.buckets)
        labels = sorted(row["bucket"] for row in newest.select("bucket").distinct().collect())  # buckets
        self.current.write(newest, -1, labels, ["event_id"])
        current = self.current.read(before=0)
        partials = deliveries.activity_of(current)
        hours = partials.select(F.unix_seconds("hour_ts").alias("s")).distinct().collect()  # of the calendar
        starts = sorted(dt.datetime.fromtimestamp(row["s"], dt.timezone.utc) for row in hours)
        self._write_hours(partials, -1, starts)
        if starts:
            put_hours(self.spark, deliveries.hourly_from_partials(self.editor_hours.read(before=0)), mart_root, starts)
        self.commit(-1)

    def adjust(self, batch: DataFrame, version: int, mart_root: str, horizon: dt.datetime | None) -> int:
        """Bring state and mart up to a batch of open deliveries; how many hours changed.

        Everything is derived from what was there before ``version``, so that a batch repeated
        after a crash at any point ends in the same state.
        """
        self.current.forget(version)
        self.editor_hours.forget(version)
        if horizon is not None:
            self.editor_hours.drop_partitions(horizon.date().isoformat())
        aside = work_dir(self.spark, "changed-deliveries")
        newest = deliveries.newest(batch, self.buckets)
        arrived = [row["bucket"] for row in newest.select("bucket").distinct().collect()]
        known = self.current.read(before=version, values=arrived)
        deliveries.changes(newest, known, horizon).write.parquet(aside)
        try:
            starts = self._apply(self.spark.read.parquet(aside), version, horizon)
            if starts:
                hours = self.spark.createDataFrame([(start,) for start in starts], "hour_ts timestamp")
                partials = self.editor_hours.read(before=version + 1, values=_days(starts))
                partials = partials.join(hours, "hour_ts", "left_semi")
                put_hours(self.spark, deliveries.hourly_from_partials(partials), mart_root, starts)
        finally:
            storage.delete(self.spark, aside)
        self.commit(version)
        return len(starts)

    def _apply(self, changed: DataFrame, version: int, horizon: dt.datetime | None) -> list[dt.datetime]:
        touched = sorted(row["bucket"] for row in changed.select("bucket").distinct().collect())
        if not touched:
            return []
        before = self.current.read(before=version, values=touched)
        self.current.write(deliveries.upserted(before, changed, horizon), version, touched, ["event_id"])
        deltas = deliveries.activity_deltas(changed)
        rows = deltas.select(F.unix_seconds("hour_ts").alias("s")).distinct().collect()  # hours, not events
        starts = sorted(dt.datetime.fromtimestamp(row["s"], dt.timezone.utc) for row in rows)
        if starts:
            old = self.editor_hours.read(before=version, values=_days(starts))
            counts = deliveries.added_up(old.drop("dt").unionByName(deltas)).where("edits <> 0")
            self._write_hours(counts, version, starts)
        return starts

    def _write_hours(self, partials: DataFrame, version: int, starts: list[dt.datetime]) -> None:
        placed = partials.withColumn("dt", day_label(F.col("hour_ts")))
        self.editor_hours.write(placed, version, _days(starts), ["hour_ts", "wiki", "user"])


def _days(starts: list[dt.datetime]) -> list[str]:
    return sorted({start.date().isoformat() for start in starts})


def mart_stream(
    spark: SparkSession,
    events: DataFrame,
    raw_root: str,
    mart_root: str,
    checkpoint: str,
    state_root: str | None = None,
    horizon_root: str | None = None,
    expired_root: str | None = None,
    buckets: int = deliveries.BUCKETS,
) -> DataStreamWriter:
    """Load every new file, then adjust the hours it touches.

    The newest delivery of an event decides, however late it comes, so the mart is at any
    time that of all raw deliveries; hours of closed days stay as they were when their day was
    closed. A batch is compared with the newest delivery of its own events and adds and takes
    what differs: no raw row is read. Deliveries of closed days go to ``expired_root``, if given.
    A batch repeated after a crash replaces what it had written. The state lies beside the
    checkpoint and belongs to it; ``buckets`` of it stays as it was when the state was begun.
    """
    state = MartState(spark, state_root or f"{checkpoint.rstrip('/')}-deliveries", buckets)
    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:8]

    def load_and_adjust(batch: DataFrame, batch_id: int) -> None:
        horizon = read_horizon(spark, horizon_root)
        load_id = f"stream-{stream}-{batch_id}"
        if not state.started() and storage.exists(spark, raw_root):
            state.start_from(read_raw_nrt(spark, raw_root), mart_root, horizon)
        inside, late = split(to_table_precision(batch), horizon)
        append_raw_nrt(inside, raw_root, load_id)
        if horizon is not None and expired_root is not None:
            write_expired(late, expired_root, load_id)
        state.adjust(inside, batch_id, mart_root, horizon)

    return events.writeStream.foreachBatch(load_and_adjust).option(
        "checkpointLocation", checkpoint
    )


def deduplicated_stream(events: DataFrame, delay: str) -> DataFrame:
    """An approximation: the first delivery of each event among those at most ``delay`` apart.

    State is kept for that long only, and events behind the watermark are dropped. Where the
    newest delivery must decide, use :func:`mart_stream`.
    """
    return events.withWatermark("event_dt", delay).dropDuplicatesWithinWatermark(["event_id"])


def hourly_activity_stream(events: DataFrame) -> DataFrame:
    """Hourly activity of a deduplicated stream, emitted when an hour can no longer change.

    Streams have no exact distinct count. Counting per editor first and adding up second
    gives one without ever holding the editors of an hour in one place.
    """
    per_editor = events.groupBy("wiki", "user", F.window("event_dt", "1 hour")).agg(
        F.count("*").alias("edits"), F.count_if("bot").alias("bot_edits")
    )
    return (
        per_editor.groupBy("wiki", F.window("window", "1 hour").alias("hour"))
        .agg(
            F.sum("edits").alias("edit_count"),
            F.sum("bot_edits").alias("bot_edit_count"),
            F.count("user").alias("distinct_editors"),
        )
        .select(
            "wiki",
            F.col("hour.start").alias("hour_ts"),
            "edit_count",
            "bot_edit_count",
            "distinct_editors",
        )
    )
