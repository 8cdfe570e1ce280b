"""Topic sink. Needs Spark's Kafka connector on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

# Full acknowledgement, no duplicates from retries, 50 ms batching.
PRODUCER = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.linger.ms": "50",
}


def topic_records(frames: DataFrame, topic: str) -> DataFrame:
    """Key (the frame's id, may be null) and untouched payload as UTF-8 bytes."""
    return frames.select(
        F.col("id").cast("binary").alias("key"),
        F.col("data").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def write_topic(records: DataFrame, servers: str) -> None:
    options = {**PRODUCER, "kafka.bootstrap.servers": servers}
    records.write.format("kafka").options(**options).save()


def stream_to_topic(records: DataFrame, servers: str, checkpoint: str) -> DataStreamWriter:
    options = {**PRODUCER, "kafka.bootstrap.servers": servers, "checkpointLocation": checkpoint}
    return records.writeStream.format("kafka").options(**options)
