"""A bitmap of fixed size that tells, without a join, which keys may be in a set."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Never changes with the data: a fuller bitmap lets more other keys pass, and costs time only.
BITS = 1 << 22


def _slot(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(BITS - 1))


class Bitmap:
    """Accepts every key it was built from, null included, and some others."""

    def __init__(self, keys: DataFrame, key: str):
        rows = (
            keys.select(_slot(F.col(key)).alias("slot"))
            .groupBy(F.shiftright("slot", 6).alias("word"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))).alias("bits"))
            .collect()  # BITS / 64 rows at most
        )
        words = [0] * (BITS // 64)
        for row in rows:
            words[row["word"]] = row["bits"]
        self.literal = json.dumps(words, separators=(",", ":"))

    def accepts(self, key: Column) -> Column:
        words = F.from_json(F.lit(self.literal), "array<bigint>")
        slot = _slot(key)
        return F.getbit(F.element_at(words, (F.shiftright(slot, 6) + 1).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1

    def divide(self, frame: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """The rows whose key is not in the set, for certain, and the rows that need a join."""
        maybe = self.accepts(F.col(key))
        return frame.where(~maybe), frame.where(maybe)
