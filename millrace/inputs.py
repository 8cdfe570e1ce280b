"""The pipeline's inputs, derived from general-purpose test tables.

``events`` stands in for the event lane and ``lineitem`` for the article lane. The
tables hold no duplicates, nulls, late or broken records, so these are derived from
remainders of the keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.dates import day_label
from millrace.operators.numbering import numbered

TOPIC = "recent-changes"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with ``ts`` as an instant and the number out of ``props``."""
    rows = table(spark, sf_dir, "events")
    return rows.withColumn("ts", F.col("ts").cast("timestamp")).withColumn(
        "k", F.regexp_extract("props", "-?[0-9]+", 0).cast("bigint")
    )


def every(n: int, remainder: int = 0) -> Column:
    return F.col("event_id") % n == remainder


def latest_event(spark: SparkSession, sf_dir: str) -> dt.datetime:
    """The time of the last event."""
    return instant(events(spark, sf_dir).agg(F.max("ts").alias("at")), "at")


def instant(one_row: DataFrame, column: str) -> dt.datetime:
    """One timestamp out of a one-row frame, as an aware datetime."""
    micros = one_row.select(F.unix_micros(column)).first()[0]
    return dt.datetime.fromtimestamp(0, dt.timezone.utc) + dt.timedelta(microseconds=micros)


def flat_events(rows: DataFrame, blank_wikis: bool = False) -> DataFrame:
    """Events in the raw table's columns; some have no user, on request some no wiki."""
    wiki = F.col("event_type")
    if blank_wikis:
        wiki = F.when(every(97), "").when(every(89), F.lit(None)).otherwise(wiki)
    return rows.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").alias("event_dt"),
        wiki.alias("wiki"),
        F.when(every(4), "log").otherwise("edit").alias("type"),
        F.col("k").alias("namespace"),
        F.concat(F.lit("Page "), F.col("k")).alias("title"),
        F.when(~every(13), F.col("user_id").cast("string")).alias("user"),
        (F.col("user_id") % 5 == 0).alias("bot"),
        F.concat(F.col("event_type"), F.lit(".example.org")).alias("server_name"),
        F.col("k").alias("length_old"),
        (F.col("k") + 7).alias("length_new"),
        (F.col("event_id") * 2).alias("revision_old"),
        (F.col("event_id") * 2 + 1).alias("revision_new"),
        F.col("props").alias("raw_json"),
    )


def raw_nrt(spark: SparkSession, sf_dir: str, blank_wikis: bool = False) -> DataFrame:
    """Deliveries: every tenth event twice, every fifteenth also in an older version."""
    rows = events(spark, sf_dir)
    older = rows.where(every(15)).withColumn("ts", F.col("ts") - F.expr("interval 5 seconds"))
    older = flat_events(older, blank_wikis).withColumn("wiki", F.lit("stale"))
    return (
        flat_events(rows, blank_wikis)
        .unionByName(flat_events(rows.where(every(10)), blank_wikis))
        .unionByName(older)
    )


def spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores: a test table is one small file, and so one task."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text: most valid, some in unusual forms, some broken."""
    rows = spread(events(spark, sf_dir))
    time = F.concat(
        F.lit('"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit('Z"')
    )
    epoch = F.unix_seconds("ts").cast("string")
    number = F.col("k").cast("string")
    parts = [
        F.lit('{"meta":{"id":"ev-'),
        F.col("event_id").cast("string"),
        F.lit('","dt":'),
        F.when(every(41), epoch).otherwise(time),
        F.lit(',"domain":"example.org"},"id":'),
        F.col("event_id").cast("string"),
        F.when(every(23), ',"type":5').otherwise(',"type":"edit"'),
        F.lit(',"namespace":'),
        F.when(every(31), F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number),
        F.lit(',"title":"Page '),
        number,
        F.lit('","user":"u'),
        F.col("user_id").cast("string"),
        F.lit('","bot":'),
        F.when(every(29), "null")
        .when(every(37), '"yes"')
        .otherwise(F.when(F.col("user_id") % 5 == 0, "true").otherwise("false")),
        F.when(every(17), "").otherwise(
            F.concat(F.lit(',"wiki":"'), F.col("event_type"), F.lit('"'))
        ),
        F.lit(',"length":{"old":'),
        number,
        F.lit(',"new":'),
        (F.col("k") + 7).cast("string"),
        F.lit("}}"),
        F.when(every(43), " trailing").otherwise(""),
    ]
    whole = F.concat(*parts)
    cut = F.substring(whole, F.lit(1), F.length(whole) - 10)
    return rows.select("event_id", "ts", F.when(every(19), cut).otherwise(whole).alias("raw_line"))


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads as a topic source delivers them."""
    return payloads(spark, sf_dir).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("raw_line").cast("binary").alias("value"),
        *_position(),
        F.col("ts").alias("timestamp"),
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where in the topic each event lies."""
    return events(spark, sf_dir).select(*_position())


def _position() -> list[Column]:
    return [
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"),
    ]


def watermarks(seen: DataFrame) -> DataFrame:
    """First and next offset of each partition."""
    return seen.groupBy("topic", "partition").agg(
        F.min("offset").alias("low"), (F.max("offset") + 1).alias("high")
    )


def committed(seen: DataFrame) -> DataFrame:
    """A group that has read part of each partition and nothing of the last."""
    part = F.floor(F.max("offset") * (F.col("partition") + 1) / 5)
    return seen.groupBy("topic", "partition").agg(
        F.when(F.col("partition") == 3, F.lit(-1)).otherwise(part).cast("bigint").alias("committed")
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the time they arrived: after 30 s, some 90 minutes later still."""
    delay = F.when(every(7), F.expr("interval 90 minutes 30 seconds")).otherwise(
        F.expr("interval 30 seconds")
    )
    return events(spark, sf_dir).select(
        F.col("event_type").alias("source"),
        F.col("ts").alias("event_dt"),
        (F.col("ts") + delay).alias("arrived_at"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing: seven files per event date."""
    path = F.concat(
        F.lit("buffer/dt="),
        day_label(F.col("ts")),
        F.lit("/part-"),
        (F.col("event_id") % 7).cast("string"),
        F.lit(".parquet"),
    )
    return (
        events(spark, sf_dir)
        .groupBy(path.alias("file_path"))
        .agg(F.max("ts").alias("modified_at"), F.count("*").alias("row_count"))
    )


def manifest(files: DataFrame) -> DataFrame:
    """A load that got four of every seven files."""
    part = F.regexp_extract("file_path", r"part-(\d+)", 1).cast("int")
    loaded_at = (F.col("modified_at") + F.expr("interval 1 hour")).alias("loaded_at")
    return files.where(part < 4).select("file_path", loaded_at, "row_count")


def article_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly article totals per project and access."""
    year = F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1))
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            year.alias("date"),
            F.col("l_returnflag").alias("project"),
            F.col("l_linestatus").alias("access"),
            "l_partkey",
        )
        .agg(F.sum("l_quantity").cast("bigint").alias("views"))
    )


def raw_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article totals ranked within each date, project and access."""
    ranked = numbered(
        article_views(spark, sf_dir),
        ["date", "project", "access"],
        [F.desc("views"), F.asc("l_partkey")],
        "rank",
    )
    return ranked.select(
        "date",
        "project",
        "access",
        F.col("l_partkey").cast("string").alias("article"),
        "views",
        "rank",
        F.date_add("date", 1).cast("timestamp").alias("fetched_at"),
    )


# Reports list at most this many articles.
REPORT_SIZE = 1000


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article totals as report documents; some have no items, some are errors."""
    page = F.floor(F.col("l_partkey") / REPORT_SIZE).cast("bigint")
    entry = F.struct(
        F.col("l_partkey").cast("string").alias("article"),
        "views",
        (F.col("l_partkey") % REPORT_SIZE + 1).alias("rank"),
    )
    listed = (
        article_views(spark, sf_dir)
        .groupBy("date", "project", "access", page.alias("page"))
        .agg(F.collect_list(entry).alias("articles"))
    )
    nth = (F.col("page") + F.year("date")) % 9
    whole = F.to_json(F.struct(F.array(F.struct("project", "articles")).alias("items")))
    payload = (
        F.when(nth == 7, '{"items":[]}').when(nth == 8, '{"detail":"not found"}').otherwise(whole)
    )
    return listed.select("date", "project", "access", payload.alias("payload"))


# Frames per captured connection.
CAPTURE_SIZE = 1000


def write_captures(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Captured stream text: a connection per thousand events, each cut off at its end."""

    def line(condition: Column | None, *parts: Column | str) -> Column:
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.lit("\n"))
        return text if condition is None else F.when(condition, text).otherwise("")

    number = F.col("event_id").cast("string")
    frame = F.concat(
        line(every(5), ": keep-alive"),
        line(~every(3, 1) & ~every(21), "id: ", number),
        line(every(21), "id: bad\x00", number),
        line(every(4), "event: ", F.col("event_type")),
        line(~every(9), "data: ", F.col("props")),
        line(every(6) & ~every(9), "data:  second of ", number),
        line(every(8), "retry: 10"),
    )
    connection = F.floor(F.col("event_id") / CAPTURE_SIZE).cast("bigint").alias("connection")
    frames = events(spark, sf_dir).select(connection, "event_id", frame.alias("value"))
    cut_off = frames.groupBy("connection").agg(
        (F.max("event_id") + 1).alias("event_id"), F.lit("data: cut off").alias("value")
    )
    (
        frames.unionByName(cut_off)
        .repartition("connection")
        .sortWithinPartitions("connection", "event_id")
        .drop("event_id")
        .write.partitionBy("connection")
        .text(root)
    )


def portable(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, for comparison with engines that know no zones."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
