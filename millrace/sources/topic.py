"""Topic source. Needs Spark's Kafka connector on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    topic: str,
    group_id: str,
    flush_records: int = 500,
    flush_seconds: int = 30,
    starting_offsets: str = "earliest",
    max_records: int = 500_000,
) -> dict[str, str]:
    """Reader options: one topic, from the earliest offset when none is checkpointed.

    A micro-batch starts once ``flush_records`` are waiting or ``flush_seconds`` have
    passed, whichever comes first, and takes ``max_records`` at most: a backlog of any
    size arrives in batches that fit.
    """
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "groupIdPrefix": group_id,
        "startingOffsets": starting_offsets,
        "minOffsetsPerTrigger": str(flush_records),
        "maxTriggerDelay": f"{flush_seconds}s",
        "maxOffsetsPerTrigger": str(max_records),
    }


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The topic as a stream of ``key, value, topic, partition, offset, timestamp``."""
    return spark.readStream.format("kafka").options(**options).load()
