"""Best-fit packing by minimum bin slack.

Documents become pieces of at most one sequence. The pieces are dealt at random into batches
of bounded size; within a batch, sequences are filled one by one: the longest piece left goes
in first, and a subset-sum over the lengths left, held as the bits of one integer, finds the
combination that fills the rest best. What is chosen is removed. Random batches of many pieces
have a good mix of lengths, so only the last sequences of a batch can have slack; their pieces
are packed once more together.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import prepare, stored
from millrace.llm.tokens import word_tokenizer

SEQUENCE = 4096
#: The id that closes every document.
CLOSING_ID = 1
#: Tokens dealt to one batch: some 1,000 sequences.
BATCH_TOKENS = 1000 * SEQUENCE
#: A sequence filled to this share is final; pieces of emptier ones are packed again.
FULL_ENOUGH = 0.995

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
_PIECES_DDL = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def cut_pieces(docs: DataFrame, tokenizer_path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """The token pieces of every document, in order; with ``ids`` (array<int>) if asked.

    Each document's ids end with ``CLOSING_ID``, so that an empty or null text is one piece of
    one token. Longer documents are cut every ``sequence`` tokens. Repeated rows give repeated
    pieces; other columns are not read.
    """
    prepare(docs.sparkSession)
    schema = _PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        for batch in batches:
            rows = []
            texts = [text or "" for text in batch.column("text").to_pylist()]
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.encode(texts)):
                ids = np.append(ids, np.array([CLOSING_ID], dtype="<u4"))
                for number, start in enumerate(range(0, len(ids), sequence)):
                    part = ids[start : start + sequence]
                    row = {
                        "doc_id": doc_id,
                        "piece": number,
                        "start": start,
                        "length": len(part),
                        "ids_crc32": zlib.crc32(part.tobytes()),
                    }
                    if with_ids:
                        row["ids"] = part.tolist()
                    rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ddl = _PIECES_DDL + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, ddl)


def fullest(lengths: list[int], room: int) -> list[int]:
    """Distinct positions of ``lengths`` whose sum is the largest that fits ``room``.

    ``reached[i]`` has bit s set if some of the first i lengths sum up to s.
    """
    within = (1 << (room + 1)) - 1
    reached, full = [1], 1 << room
    for length in lengths:
        sums = reached[-1]
        if sums & full:
            break
        reached.append(sums | ((sums << length) & within))
    best = reached[-1].bit_length() - 1
    chosen = []
    for position in range(len(reached) - 2, -1, -1):
        if not (reached[position] >> best) & 1:
            chosen.append(position)
            best -= lengths[position]
    return chosen


def pack(lengths: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length. All lengths lie in 1..sequence."""
    by_length: dict[int, list[int]] = {}
    for position in np.argsort(lengths, kind="stable")[::-1]:
        by_length.setdefault(int(lengths[position]), []).append(int(position))
    left = Counter({length: len(positions) for length, positions in by_length.items()})
    order = sorted(left, reverse=True)
    numbers = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    number = 0
    while order:
        first = order[0]
        left[first] -= 1
        room = sequence - first
        # No more of one length than could fit; long before short finds full sums early.
        usable = [x for x in order if x <= room for _ in range(min(left[x], room // x))]
        chosen = [first, *(usable[i] for i in fullest(usable, room))] if room and usable else [first]
        for length in chosen[1:]:
            left[length] -= 1
        offset = 0
        for length in chosen:
            position = by_length[length].pop()
            numbers[position], offsets[position] = number, offset
            offset += length
        number += 1
        if any(left[x] == 0 for x in set(chosen)):
            order = [x for x in order if left[x]]
    return numbers, offsets


def _pack_batch(batch: pd.DataFrame, sequence: int) -> pd.DataFrame:
    batch = batch.sort_values(["doc_id", "piece"], kind="stable", ignore_index=True)
    numbers, offsets = pack(batch["length"].to_numpy(), sequence)
    used = np.bincount(numbers, weights=batch["length"], minlength=1)
    return batch.assign(number=numbers, offset=offsets, used=used[numbers].astype("int64"))


def pack_pieces(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` (with ``length`` in 1..sequence) with ``sequence_id`` and ``offset``.

    Every row is placed exactly once and the rows of a sequence follow one another without a
    gap. Number and size of batches follow from the data; a hot document is dealt like any
    other, by piece.
    """
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == sequence
    alone = pieces.where(whole).withColumns(
        {"round": F.lit(0), "batch": F.col("row"), "number": F.lit(0).cast("bigint"), "offset": F.lit(0).cast("bigint")}
    )
    first = _round(pieces.where(~whole), 1, sequence)
    first = stored(first, "packed")
    final = F.col("used") >= FULL_ENOUGH * sequence
    columns = [*pieces.columns, "round", "batch", "number", "offset"]
    second = _round(first.where(~final).select(pieces.columns), 2, sequence)
    placed = alone.select(columns).unionByName(first.where(final).select(columns)).unionByName(second.select(columns))
    return placed.withColumn("sequence_id", F.xxhash64("round", "batch", "number")).drop(
        "row", "round", "batch", "number"
    )


def _round(pieces: DataFrame, number: int, sequence: int) -> DataFrame:
    total = pieces.agg(F.sum("length")).first()[0] or 0
    batches = -(-total // BATCH_TOKENS) or 1
    dealt = pieces.withColumns(
        {"round": F.lit(number), "batch": F.pmod(F.xxhash64("row", F.lit(number)), F.lit(batches))}
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.groupBy("batch").applyInPandas(
        lambda batch: _pack_batch(batch, sequence), f"{fields}, number bigint, offset bigint, used bigint"
    )
