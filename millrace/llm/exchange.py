"""Corpus-wide totals of 64-bit keys, asked for and answered by blocks of documents.

A block is what one task packs from a bounded amount of text. It asks once for each of its
distinct keys, with its own counts, so that a key that stands everywhere comes once per block and
not once per occurrence. Keys and counts travel as packed arrays, one row per block and bucket of
keys; a bucket's task adds up what all blocks know of its keys and answers every block in the order
of that block's question. Two shuffles, no join of rows, and no key's list of documents anywhere.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Keys one bucket holds on average, repetitions in several blocks included.
BUCKET_KEYS = 1 << 20
LEAST_BUCKETS = 64

QUESTIONS = "block bigint, held boolean, kind int, bucket int, keys binary, counts binary"
ANSWERS = "block bigint, held boolean, kind int, bucket int, answer binary, types bigint"

#: Totals of distinct keys (n x counts) in key order, to what blocks are told about each key.
Resolve = Callable[[np.ndarray, np.ndarray], np.ndarray]


def bucket_count(keys: int) -> int:
    """A power of two, in proportion to the keys asked for."""
    return 1 << max(LEAST_BUCKETS, -(-keys // BUCKET_KEYS)).__sub__(1).bit_length()


def planes(numbers: np.ndarray, size: int = 8) -> bytes:
    """Whole numbers by byte: all lowest bytes, then all second ones. Long runs compress well."""
    whole = np.ascontiguousarray(numbers, dtype=f"<u{size}")
    return whole.view(np.uint8).reshape(-1, size).T.tobytes()


def numbers(data: bytes, size: int = 8) -> np.ndarray:
    stacked = np.frombuffer(data, dtype=np.uint8).reshape(size, -1)
    return np.ascontiguousarray(stacked.T).view(f"<u{size}").reshape(-1)


def fewest(whole: np.ndarray) -> bytes:
    """``planes`` without the highest bytes that are zero throughout; the first byte says how many are left."""
    whole = np.ascontiguousarray(whole, dtype="<u8")
    size = max(1, -(-int(whole.max(initial=0)).bit_length() // 8))
    return bytes([size]) + planes(whole)[: size * len(whole)]


def from_fewest(data: bytes | pa.Buffer) -> np.ndarray:
    size = memoryview(data)[0]
    stacked = np.frombuffer(data, dtype=np.uint8, offset=1).reshape(size, -1)
    whole = np.zeros((stacked.shape[1], 8), dtype=np.uint8)
    whole[:, :size] = stacked.T
    return whole.view("<u8").reshape(-1)


def questions(
    block: int, held: bool, kind: int, keys: np.ndarray, counts: np.ndarray, bounds: np.ndarray
) -> Iterator[dict]:
    """One row per bucket of a block's keys, which are sorted; ``bounds`` cut the key space.

    ``counts`` is n x counts, below 2**32 in one block. Buckets without a key of the block have no row.
    """
    cuts = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
    for bucket, (start, stop) in enumerate(zip(cuts, cuts[1:])):
        if start < stop:
            yield {
                "block": block,
                "held": held,
                "kind": kind,
                "bucket": bucket,
                "keys": planes(keys[start:stop]),
                "counts": planes(counts[start:stop].T.reshape(-1), 4),
            }


def even_bounds(buckets: int) -> np.ndarray:
    """Where buckets of evenly spread 64-bit keys begin, but for the first."""
    return np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // buckets)


def answers(asked: DataFrame, resolve: Resolve) -> DataFrame:
    """An answer (``fewest`` of resolve's rows, column by column) to every question.

    ``types`` holds, in one row per kind and bucket, how many distinct keys have a first count
    above zero, and 0 in the others. One task holds the keys of one bucket.
    """
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("held", pa.bool_()),
            ("kind", pa.int32()),
            ("bucket", pa.int32()),
            ("answer", pa.binary()),
            ("types", pa.int64()),
        ]
    )

    def run(group: pa.Table) -> pa.Table:
        asked_keys = [numbers(data.as_py()) for data in group["keys"]]
        sizes = np.array([len(keys) for keys in asked_keys])
        keys, places = np.unique(np.concatenate(asked_keys), return_inverse=True)
        width = len(group["counts"][0].as_py()) // 4 // len(asked_keys[0])
        totals = np.zeros((len(keys), width), dtype=np.int64)
        ends = np.cumsum(sizes)
        for own, end, data in zip(sizes, ends, group["counts"]):
            # A block names a key once, so that plain indexing adds up.
            totals[places[end - own : end]] += numbers(data.as_py(), 4).astype(np.int64).reshape(width, own).T
        told = resolve(keys, totals)
        types = [0] * len(sizes)
        types[0] = int((totals[:, 0] > 0).sum())
        return pa.table(
            [
                group["block"],
                group["held"],
                group["kind"],
                group["bucket"],
                pa.array([fewest(told[places[end - own : end]].T.reshape(-1)) for own, end in zip(sizes, ends)], pa.binary()),
                pa.array(types, pa.int64()),
            ],
            schema=schema,
        )

    return asked.groupBy("kind", "bucket").applyInArrow(run, ANSWERS)


def put_together(told: pa.Table, kind: int, width: int) -> np.ndarray:
    """The answers (n x width) to one block's questions of a kind, in the order of its keys."""
    rows = [row for row, own in enumerate(told["kind"].to_pylist()) if own == kind]
    buckets = told["bucket"].to_pylist()
    rows.sort(key=buckets.__getitem__)
    parts = [from_fewest(told["answer"][row].as_buffer()).astype(np.int64).reshape(width, -1).T for row in rows]
    return np.concatenate(parts) if parts else np.zeros((0, width), dtype=np.int64)
