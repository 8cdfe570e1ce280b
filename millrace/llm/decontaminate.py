"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The seeds of an item are those of its word n-grams that few items hold; an n-gram many items
share, a question phrase say, tells nothing about which item a document contains and would pair
every such document with every such item. Where a long stretch of an item has no rare n-gram, as in
a passage that many questions are asked about, the rarest of the stretch is a seed, and an item
without any seed is led by its rarest n-grams. A document and an item that share a seed are aligned, however often the seed
or the item occurs in the corpus. Seeds on the same diagonal, the place in the document less the
place in the item, ask for the same passage, so that only the diagonals are kept. Only passages
around them are joined with items; edits, insertions and deletions cost a little, and the best
local alignment tells what part of the item the document contains. Passages with too few of the
item's words to reach the threshold are passed over before the alignment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import keyed, prepare, stored
from millrace.llm.words import shingle_hashes, word_hashes

#: Words of an n-gram; a copy without so many unchanged words in a row isn't found.
SEED = 4
#: Share of the item's words (or of ``LONG_ITEM`` of them) that must be found in one alignment.
THRESHOLD = 0.5
#: Longer items count as found when a passage of this many words is.
LONG_ITEM = 60
#: So many words must be found whatever the share; of a shorter item all.
LEAST_WORDS = 8
MATCH, MISMATCH, GAP = 2, -1, -1
#: Items that may hold a seed. A document joins so many items at most for each of its n-grams,
#: unless an item has no n-gram as rare as that.
RARE = 16
#: Neighbouring n-grams none of which is rare, but which are no phrase any more: one of them is a
#: seed unless more than ``TEMPLATE`` items hold it too.
STRETCH = 12
TEMPLATE = 1000
#: The filter that keeps n-grams of no item out of the join has so many bits per seed, up to
#: 8 MiB in all; a fuller one lets more n-grams pass, and changes no result.
BITS_PER_SEED = 64
#: Words of all items together that are sent to every task (8 bytes each); more are joined by id.
BROADCAST_WORDS = 1 << 20
LEAST_BITS, MOST_BITS = 1 << 19, 1 << 26

_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str) -> list[str]:
    """Letters and digits only, so that punctuation and case never hide a copy."""
    return _TOKEN.findall(text.lower())


def grams(text: str | None) -> np.ndarray:
    """Hashes of the word n-grams of a text; a shorter text is one gram, an empty one none."""
    return shingle_hashes(word_hashes(tokens(text or "")), SEED).view(np.int64)


def item_grams(items: DataFrame) -> DataFrame:
    """``item_id, place, gram``: the n-grams of each item's ``words`` in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(batch.column("item_id").to_pylist(), batch.column("words").to_pylist()):
                found = shingle_hashes(np.frombuffer(words, dtype=np.uint64), SEED).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found), pa.int64()), pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found)],
                    names=["item_id", "place", "gram"],
                )

    return items.select("item_id", "words").mapInArrow(run, "item_id bigint, place int, gram bigint")


def seeds(item_side: DataFrame, rare: int = RARE) -> DataFrame:
    """Of ``item_id, place, gram`` the rows whose n-gram at most ``rare`` items hold.

    Of every ``STRETCH`` n-grams in a row without such a one, the one that the fewest hold, if
    at most ``TEMPLATE`` do. Of an item without any of these, those that the fewest hold.
    """
    held = item_side.select("item_id", "gram").distinct().groupBy("gram").agg(F.count("*").alias("items"))
    weighed = item_side.join(held, "gram")
    stretch = F.floor(F.col("place") / STRETCH).alias("stretch")
    best = weighed.groupBy("item_id", stretch).agg(
        F.min(F.struct("items", "place", "gram")).alias("best"), F.count_distinct("place").alias("size")
    )
    in_stretches = best.where((F.col("size") == STRETCH) & F.col("best.items").between(rare + 1, TEMPLATE)).select(
        "item_id", "best.place", "best.gram"
    )
    fewest = weighed.groupBy("item_id").agg(F.min("items").alias("fewest"))
    fit = (F.col("items") <= rare) | ((F.col("items") == F.col("fewest")) & (F.col("fewest") > rare))
    chosen = weighed.join(fewest, "item_id").where(fit).select("item_id", "place", "gram")
    return chosen.unionByName(in_stretches).distinct()


def _filter(seed_side: DataFrame) -> bytes:
    """A bitmap with a bit for every seed, in proportion to their number up to ``MOST_BITS``."""
    wanted = BITS_PER_SEED * seed_side.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (wanted - 1).bit_length() if wanted else 0))

    def packed(group: pa.Table) -> pa.Table:
        block = np.zeros(LEAST_BITS, dtype=np.uint8)
        block[group["gram"].to_numpy() & (LEAST_BITS - 1)] = 1
        return pa.table({"part": group["part"][:1], "bits": pa.array([np.packbits(block, bitorder="little").tobytes()], pa.binary())})

    part = F.shiftright(F.col("gram").bitwiseAND(F.lit(bits - 1)), LEAST_BITS.bit_length() - 1).cast("int")
    parts = seed_side.select(part.alias("part"), "gram").distinct().groupBy("part").applyInArrow(packed, "part int, bits binary")
    size = LEAST_BITS // 8
    filled = bytearray(bits // 8)
    for row in parts.toLocalIterator():  # MOST_BITS in all
        filled[row["part"] * size : (row["part"] + 1) * size] = row["bits"]
    return bytes(filled)


def occurrences(docs: DataFrame, bitmap: bytes) -> DataFrame:
    """``doc_id, place, gram`` for the n-grams of the corpus that pass the filter.

    Whole texts; ``place`` counts words.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bitmap, dtype=np.uint8)
        for batch in batches:
            ids, places, found = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                hashes = grams(text)
                bit = hashes & (8 * len(known) - 1)
                at = np.flatnonzero(known[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
                ids += [doc_id] * len(at)
                places.append(at.astype(np.int32))
                found.append(hashes[at])
            empty = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.concatenate(places or empty[0])), pa.array(np.concatenate(found or empty[1]))],
                names=["doc_id", "place", "gram"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, place int, gram bigint")


def diagonals(seed_side: DataFrame, corpus_side: DataFrame) -> DataFrame:
    """``doc_id, item_id, diagonals`` for every document and item with a seed in common."""
    return (
        corpus_side.join(seed_side.withColumnRenamed("place", "item_place"), "gram")
        .groupBy("doc_id", "item_id")
        .agg(F.collect_set(F.col("place") - F.col("item_place")).alias("diagonals"))
    )


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Matched words of the best local alignment, and its first and last + 1 word in ``passage``.

    Smith-Waterman with linear gaps, one row of the table per word of the item. Of equally good
    alignments the one that ends first is taken.
    """
    m = len(passage)
    if m == 0 or len(item) == 0:
        return 0, 0, 0
    table = np.zeros((len(item) + 1, m + 1), dtype=np.int32)
    slope = GAP * np.arange(m + 1)
    equal = passage[None, :] == item[:, None]
    for i in range(1, len(item) + 1):
        row = table[i]
        diagonal = table[i - 1, :-1] + np.where(equal[i - 1], MATCH, MISMATCH)
        row[1:] = np.maximum(np.maximum(diagonal, table[i - 1, 1:] + GAP), 0)
        # Gaps along the row: the best earlier cell, less what the way from there costs.
        row[:] = np.maximum.accumulate(row - slope) + slope
    i, j = np.unravel_index(int(np.argmax(table)), table.shape)
    end, matched = int(j), 0
    while i and j and table[i, j] > 0:
        score = MATCH if equal[i - 1, j - 1] else MISMATCH
        if table[i, j] == table[i - 1, j - 1] + score:
            matched += score == MATCH
            i, j = i - 1, j - 1
        elif table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return int(matched), int(j), end


def passages(words: int, length: int, found: list[int]) -> Iterator[tuple[int, int]]:
    """Where to look for an item of ``length`` words in a text of ``words``, by its diagonals.

    Overlapping passages are joined; long joined ones are cut into overlapping parts, to bound
    the table of an alignment.
    """
    slack = 8 + length // 4
    spans: list[list[int]] = []
    for diagonal in sorted(found):
        first = max(0, diagonal - slack)
        last = min(words, diagonal + length + slack)
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], last)
        else:
            spans.append([first, last])
    step = 4 * (length + slack) + 64
    for first, last in spans:
        for start in range(first, last, step):
            yield start, min(last, start + step + 2 * (length + slack))


def share_found(part: np.ndarray, item: np.ndarray, threshold: float = 0.0) -> tuple[float, int, int]:
    """Share of the item in the best alignment with a passage, and its words there.

    Zero where the passage cannot reach ``threshold``.
    """
    needed = min(len(item), LONG_ITEM)
    # No alignment matches more words than either side has of the other's.
    most = min(int(np.isin(part, item).sum()), int(np.isin(item, part).sum())) / needed
    if most < threshold:
        return 0.0, 0, 0
    matched, first, last = align(part, item)
    return min(1.0, matched / needed), first, last


def best_alignment(words: np.ndarray, item: np.ndarray, found: list[int], threshold: float = 0.0) -> tuple[float, int, int]:
    """Share of the item found, and the word span, over the passages around all diagonals."""
    best = (0.0, 0, 0)
    for start, stop in passages(len(words), len(item), found):
        share, first, last = share_found(words[start:stop], item, threshold)
        if share > best[0]:
            best = (share, start + first, start + last)
    return best


def bar_of(length: int, threshold: float) -> float:
    """The share of an item of ``length`` words that must be found."""
    return max(threshold, min(length, LEAST_WORDS) / max(1, min(length, LONG_ITEM)))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word``: the items each document contains.

    ``score`` is the share of the item's words in the best alignment; it must reach ``threshold``
    and come to ``LEAST_WORDS`` words, or all of a shorter item's. The document must hold a seed
    of the item: a phrase it shares with more than ``RARE`` items is no sign of any of them.
    Items of equal words count as one item there, and all are reported. Null and empty texts on
    either side contain nothing and are contained in nothing; items of fewer than ``SEED`` words
    are found only where a text consists of the same words. Rows that repeat a ``doc_id`` are
    judged together, as are repeated items; other columns are not read. A document without
    ``doc_id`` is not reported.
    """
    items = stored(_items(benchmark), "items")
    first = items.groupBy("words").agg(F.min("item_id").alias("first_id"))
    alike = stored(items.join(first, "words").select("item_id", "first_id"), "alike-items")
    single = stored(items.join(alike.where("item_id = first_id"), "item_id").select("item_id", "words", "length"), "single-items")
    seed_side = stored(seeds(item_grams(single.select("item_id", "words"))), "seeds")
    corpus_side = stored(occurrences(docs.where("doc_id IS NOT NULL"), _filter(seed_side)), "corpus-grams")
    hits = diagonals(seed_side, corpus_side).join(single.select("item_id", "length"), "item_id")
    # As many as a document has words, RARE times, at most; no texts.
    per_doc = stored(hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "length", "diagonals")).alias("items")), "hits")
    # Texts without a hit need not move.
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where(F.col("text").isNotNull())
    texts = keyed(named, per_doc.select("doc_id"), "left_semi")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text, wanted in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "items"))):
                found = word_hashes(tokens(text))
                rows = [
                    {"doc_id": doc_id, "item_id": item["item_id"], "start": start, "part": found[start:stop].tobytes()}
                    for item in wanted
                    for start, stop in passages(len(found), item["length"], item["diagonals"])
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=_PASSAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, item_id, start, part, words, length in zip(*(column.to_pylist() for column in batch.columns)):
                bar = bar_of(length, threshold)
                item = np.frombuffer(words, dtype=np.uint64)
                score, first_word, last_word = share_found(np.frombuffer(part, dtype=np.uint64), item, bar)
                if score >= bar:
                    rows.append({"doc_id": doc_id, "item_id": item_id, "score": score, "first_word": start + first_word, "last_word": start + last_word})
            yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    parts = texts.join(per_doc, "doc_id").mapInArrow(cut, "doc_id bigint, item_id bigint, start int, part binary")
    few = single.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0] <= BROADCAST_WORDS
    sides = parts.join(F.broadcast(single) if few else single, "item_id")
    found = sides.select("doc_id", "item_id", "start", "part", "words", "length").mapInArrow(
        run, "doc_id bigint, item_id bigint, score double, first_word int, last_word int"
    )
    best = F.max(F.struct("score", F.negate("first_word").alias("before"), "last_word")).alias("best")
    return (
        found.groupBy("doc_id", F.col("item_id").alias("first_id"))
        .agg(best)
        .join(alike, "first_id")
        .select("doc_id", "item_id", "best.score", F.negate(F.col("best.before")).alias("first_word"), "best.last_word")
    )


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, words, length``: each item's words as hashes; of repeated items the largest text."""
    texts = benchmark.where("item_id IS NOT NULL").groupBy(F.col("item_id").cast("bigint").alias("item_id")).agg(
        F.max(F.coalesce("text", F.lit(""))).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [word_hashes(tokens(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array([x.tobytes() for x in found], pa.binary()), pa.array([len(x) for x in found], pa.int32())],
                names=["item_id", "words", "length"],
            )

    return texts.mapInArrow(run, "item_id bigint, words binary, length int").where("length > 0")


_PASSAGES = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int32()), ("part", pa.binary())])
_FOUND = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32())]
)


def keep_clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns."""
    return keyed(docs, stored(contaminated(docs, benchmark, threshold).select("doc_id").distinct(), "tainted"), "left_anti")
