"""Writers of the raw tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from millrace import schemas, storage
from millrace.functions.dates import day_label, month_label


def to_table_precision(events: DataFrame) -> DataFrame:
    """Event times as the table keeps them: milliseconds."""
    return events.withColumn("event_dt", F.date_trunc("millisecond", "event_dt"))


def append_raw_nrt(events: DataFrame, root: str, load_id: str | None = None) -> None:
    """Add events to the raw table, by event date, ordered for data skipping inside it.

    Every load has directories of its own. Running a load of the same id again replaces what
    it wrote, so that a crash half-way leaves no row twice; without an id the rows are a load
    of their own.
    """
    rows = to_table_precision(events).select(*schemas.RAW_NRT.names)
    placed = rows.withColumn("dt", day_label(F.col("event_dt"))).withColumn(
        "load", F.lit(load_id or f"load-{uuid.uuid4().hex}")
    )
    storage.replace_partitions(placed, root, ["dt", "load"], schemas.RAW_NRT_SORT)


def write_expired(late: DataFrame, root: str, load_id: str) -> None:
    """Keep deliveries whose day was closed when they came, by load, apart from the raw table."""
    rows = to_table_precision(late).select(*schemas.RAW_NRT.names)
    placed = rows.withColumn("dt", day_label(F.col("event_dt"))).withColumn("load", F.lit(load_id))
    storage.replace_partitions(placed, root, ["dt", "load"], schemas.RAW_NRT_SORT)


def raw_batch_rows(articles: DataFrame, fetched_at: dt.datetime) -> DataFrame:
    """Article rows in table order, stamped with the one time of this fetch."""
    stamped = articles.withColumn("fetched_at", F.lit(fetched_at).cast("timestamp"))
    return stamped.select(*schemas.RAW_BATCH.names)


def append_raw_batch(articles: DataFrame, root: str, fetched_at: dt.datetime) -> int:
    """Add article rows by month and return how many; none adds nothing.

    A repeated fetch is added again. The grain check reports it.
    """
    rows = raw_batch_rows(articles, fetched_at).withColumn("month", month_label(F.col("date")))
    totals = Observation()
    counted = rows.observe(totals, F.count("*").alias("rows"))
    storage.append_partitioned(counted, root, "month", schemas.RAW_BATCH_SORT)
    return storage.observed(totals, "rows")


def append_manifest(rows: DataFrame, root: str) -> None:
    """Record loaded files, kept by the date in their path so that a bounded load reads
    only the manifest rows of the files it looks at."""
    placed = rows.withColumn("dt", storage.path_partition(F.col("file_path")))
    ordered = placed.coalesce(1).sortWithinPartitions("dt", "file_path")
    ordered.write.mode("append").partitionBy("dt").parquet(root)
