"""The newest delivery of every event as a table, and what a batch of deliveries changes in it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import hour_start
from millrace.horizon import is_open
from millrace.operators.staging import latest_delivery

#: All the hourly mart needs of an event.
ACTIVITY = ["event_id", "event_dt", "wiki", "user", "bot"]
#: Buckets of the current table. More for larger tables: a batch reads those its events are in.
BUCKETS = 32


def bucket_label(event_id: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of an event, as a partition value."""
    return F.lpad(F.pmod(F.xxhash64(event_id), F.lit(buckets)).cast("string"), 5, "0")


def touched_hours(raw: DataFrame, batch: DataFrame) -> DataFrame:
    """The hours whose activity a batch of deliveries may change.

    Those of the deliveries, and those of all earlier deliveries of the same events: an
    event leaves an hour when a newer delivery puts it into another.
    """
    ids = batch.select("event_id").distinct()
    return (
        raw.select("event_id", "event_dt")
        .join(ids, "event_id", "left_semi")
        .select(hour_start(F.col("event_dt")).alias("hour_ts"))
        .distinct()
    )


def newest(batch: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per event of a batch, with the bucket its event belongs to."""
    return latest_delivery(batch, ACTIVITY).withColumn("bucket", bucket_label(F.col("event_id"), buckets))


def changes(batch_newest: DataFrame, current: DataFrame, horizon: dt.datetime | None) -> DataFrame:
    """``event_id, bucket, new, old``: the events whose newest delivery a batch replaces.

    ``new`` and ``old`` hold the other activity columns; ``old`` is null for an event that was
    not there, or whose delivery lies in a closed day. Newest is the latest time, and among
    equal times the smallest wiki, user and bot, nulls first, as in the staging layer. Both
    sides have one row per event, so no key is hot.
    """
    shown = [c for c in ACTIVITY if c != "event_id"]
    known = current.where(is_open(F.col("event_dt"), horizon)).select(
        "bucket", "event_id", F.struct(*shown).alias("old")
    )
    compared = batch_newest.select("bucket", "event_id", F.struct(*shown).alias("new")).join(
        known, ["bucket", "event_id"], "left"
    )
    ties = [F.struct(*(F.col(f"{side}.{c}") for c in ("wiki", "user", "bot"))) for side in ("new", "old")]
    replaces = (
        F.col("old").isNull()
        | (F.col("new.event_dt") > F.col("old.event_dt"))
        | ((F.col("new.event_dt") == F.col("old.event_dt")) & (ties[0] < ties[1]))
    )
    return compared.where(replaces).select("event_id", "bucket", "new", "old")


def upserted(current: DataFrame, changed: DataFrame, horizon: dt.datetime | None) -> DataFrame:
    """The touched buckets of the current table after a batch, closed days left out."""
    kept = current.join(changed.select("bucket", "event_id"), ["bucket", "event_id"], "left_anti")
    entered = changed.select("event_id", "new.*", "bucket")
    return kept.unionByName(entered).where(is_open(F.col("event_dt"), horizon))


def activity_deltas(changed: DataFrame) -> DataFrame:
    """What changed events add to and take from ``wiki, hour_ts, user``.

    An event that stays in its hour but names another editor moves between editors; one that
    changes nothing the mart shows has no row.
    """

    def side(name: str, sign: int) -> DataFrame:
        row = F.col(name)
        return changed.where(row.isNotNull()).select(
            row["wiki"].alias("wiki"),
            hour_start(row["event_dt"]).alias("hour_ts"),
            row["user"].alias("user"),
            F.lit(sign).cast("bigint").alias("edits"),
            F.when(row["bot"], sign).otherwise(0).cast("bigint").alias("bot_edits"),
        )

    return added_up(side("new", 1).unionByName(side("old", -1))).where("edits <> 0 OR bot_edits <> 0")


def added_up(partials: DataFrame) -> DataFrame:
    """Partial counts of the same wiki, hour and editor in one row."""
    return partials.groupBy("wiki", "hour_ts", "user").agg(
        F.sum("edits").alias("edits"), F.sum("bot_edits").alias("bot_edits")
    )


def activity_of(newest_deliveries: DataFrame) -> DataFrame:
    """The partial counts of deduplicated events."""
    return added_up(
        newest_deliveries.select(
            "wiki",
            hour_start(F.col("event_dt")).alias("hour_ts"),
            "user",
            F.lit(1).cast("bigint").alias("edits"),
            F.when(F.col("bot"), 1).otherwise(0).cast("bigint").alias("bot_edits"),
        )
    )


def hourly_from_partials(partials: DataFrame) -> DataFrame:
    """The hourly mart from counts per editor: an editor counts once however many edits."""
    return partials.where("edits > 0").groupBy("wiki", "hour_ts").agg(
        F.sum("edits").alias("edit_count"),
        F.sum("bot_edits").alias("bot_edit_count"),
        F.count("user").alias("distinct_editors"),
    )
