"""Continuous landing: topic records into the buffer, bad ones into quarantine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.contract import accepted, decode_payload, rejected, validate
from millrace.operators.offsets import flush_record
from millrace.sinks.buffer import append_flush, write_buffer, write_dead_letters


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


# Where a record came from.
_PLACE = ["topic", "partition", "offset"]


def write_judged(
    judged: DataFrame,
    buffer_root: str,
    dead_letter_root: str,
    received_at: dt.datetime,
    flush_root: str | None = None,
    flush_id: int | None = None,
) -> None:
    """Write both outcomes of validated records, validating them only once.

    The record of the flush comes last: it stands for records that are safely written.
    """
    judged = judged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_buffer(accepted(judged), buffer_root)
        write_dead_letters(rejected(judged), dead_letter_root, received_at)
        if flush_root is not None:
            append_flush(flush_record(judged, flush_id, received_at), flush_root)
    finally:
        judged.unpersist()


def land(
    records: DataFrame,
    buffer_root: str,
    dead_letter_root: str,
    received_at: dt.datetime,
    flush_root: str | None = None,
    flush_id: int | None = None,
) -> None:
    """Validate a batch of topic records and write both outcomes."""
    judged = _judge(records, flush_root)
    write_judged(judged, buffer_root, dead_letter_root, received_at, flush_root, flush_id)


def _judge(records: DataFrame, flush_root: str | None) -> DataFrame:
    return validate(decode_payload(records), carry=_PLACE if flush_root is not None else [])


def landing_stream(
    records: DataFrame,
    buffer_root: str,
    dead_letter_root: str,
    checkpoint: str,
    clock: Callable[[], dt.datetime] = utc_now,
    flush_root: str | None = None,
) -> DataStreamWriter:
    """A writer to start with the trigger of choice.

    Spark records a batch as done only after both writes returned, so records are
    landed at least once. A batch repeated after a crash writes its events again; the
    staging layer keeps one of each. With ``flush_root`` every flush leaves its next
    offsets and counts there; a repeated flush has the same id.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        write_judged(batch, buffer_root, dead_letter_root, clock(), flush_root, batch_id)

    judged = _judge(records, flush_root)
    return judged.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
