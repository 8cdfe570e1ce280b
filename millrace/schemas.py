"""Column names and types of every stored table."""

from __future__ import annotations

from pyspark.sql import types as T


# Names, order and types of the stored columns, so that tables and files
# written elsewhere to the same contract can be read and added to.

# One row per delivery of an event. Also the row shape of the file buffer.
RAW_NRT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_dt", T.TimestampType()),
        T.StructField("wiki", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("namespace", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("bot", T.BooleanType()),
        T.StructField("server_name", T.StringType()),
        T.StructField("length_old", T.LongType()),
        T.StructField("length_new", T.LongType()),
        T.StructField("revision_old", T.LongType()),
        T.StructField("revision_new", T.LongType()),
        T.StructField("raw_json", T.StringType()),
    ]
)
RAW_NRT_REQUIRED = ["event_id", "event_dt", "wiki", "type", "bot", "raw_json"]
RAW_NRT_SORT = ["wiki", "event_dt", "event_id"]

# What the deduplicated event view shows: current state only, no payload.
STG_EVENTS = [
    "event_id",
    "event_dt",
    "wiki",
    "type",
    "namespace",
    "title",
    "user",
    "bot",
    "server_name",
    "length_new",
    "revision_new",
]

# One row per article of one day's top list.
RAW_BATCH = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("project", T.StringType()),
        T.StructField("access", T.StringType()),
        T.StructField("article", T.StringType()),
        T.StructField("views", T.LongType()),
        T.StructField("rank", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
    ]
)
RAW_BATCH_SORT = ["date", "project", "rank"]

MANIFEST = T.StructType(
    [
        T.StructField("file_path", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("row_count", T.LongType()),
    ]
)

EDITS_HOURLY = T.StructType(
    [
        T.StructField("wiki", T.StringType()),
        T.StructField("hour_ts", T.TimestampType()),
        T.StructField("edit_count", T.LongType()),
        T.StructField("bot_edit_count", T.LongType()),
        T.StructField("distinct_editors", T.LongType()),
    ]
)

# Which hourly intervals of the mart have been filled, and when.
LEDGER = T.StructType(
    [
        T.StructField("hour_ts", T.TimestampType()),
        T.StructField("filled_at", T.TimestampType()),
    ]
)

# The newest delivery of each event, by bucket of its id.
CURRENT = T.StructType([field for name in ("event_id", "event_dt", "wiki", "user", "bot") for field in RAW_NRT if field.name == name])

# Edits per wiki, hour and editor, by hour: what the hourly mart is added up from.
EDITOR_HOURS = T.StructType(
    [
        T.StructField("wiki", T.StringType()),
        T.StructField("hour_ts", T.TimestampType()),
        T.StructField("user", T.StringType()),
        T.StructField("edits", T.LongType()),
        T.StructField("bot_edits", T.LongType()),
    ]
)

# The hours whose events a load may have changed, and when.
DIRTY_HOURS = T.StructType(
    [
        T.StructField("hour_ts", T.TimestampType()),
        T.StructField("dirtied_at", T.TimestampType()),
    ]
)

# Which files a load is about to read, written before anything else.
PLANNED_FILES = T.StructType([T.StructField("file_path", T.StringType())])

# What an observer has seen: the last listing and what was new in it, and the last table state.
SEEN_FILES = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("is_new", T.BooleanType())])
SEEN_STATE = T.StructType([T.StructField("max_fetched_at", T.TimestampType()), T.StructField("row_count", T.LongType())])

DEAD_LETTER = T.StructType(
    [
        T.StructField("received_at", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("raw_line", T.StringType()),
    ]
)

# The columns a topic source delivers.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# What each flush of the landing stream did, per topic partition.
FLUSHES = T.StructType(
    [
        T.StructField("flush_id", T.LongType()),
        T.StructField("flushed_at", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("accepted", T.LongType()),
        T.StructField("rejected", T.LongType()),
    ]
)

# Parsed reports, on their way to the article table.
REPORTS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("project", T.StringType()),
        T.StructField("access", T.StringType()),
        T.StructField(
            "articles",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("article", T.StringType()),
                        T.StructField("views", T.LongType()),
                        T.StructField("rank", T.LongType()),
                    ]
                )
            ),
        ),
        T.StructField("error", T.StringType()),
    ]
)

# The declared grain of each table; no two rows may share one.
GRAINS = {
    "stg_events_nrt": ["event_id"],
    "stg_events_batch": ["date", "project", "access", "article"],
    "pageviews_top": ["date", "project", "access", "article"],
    "edits_hourly": ["wiki", "hour_ts"],
}


def with_partition(schema: T.StructType, column: str) -> T.StructType:
    """The stored schema plus its string partition column."""
    return T.StructType(schema.fields + [T.StructField(column, T.StringType())])
