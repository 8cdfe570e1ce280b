"""Aligning two tokenizers over a corpus with inverted bitmaps of token pairs.

Both tokenizers cover the same bytes. Every byte range between two neighbouring token ends, of
either of them, lies in one token of each: one link per range, and a group ends where both end.

A block of documents keeps, for each pair of ids linked in it, which documents hold the pair:
bitmaps of its documents, one per binary digit of how often a document does (multiplicity planes).
OR-ed together the planes tell how many documents hold the pair, weighted by their digits how many
links there are. Blocks hold different documents, so that their counts add up; they are exchanged
through :mod:`millrace.llm.exchange`, by the second id, whose most frequent pair is found there.
The answers go back along the postings: each plane adds its pair's count to the documents in it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import exchange
from millrace.llm.tables import prepare, stored
from millrace.llm.tokens import _byte_letters

#: A block is full at so many documents, or at so many token ids.
BLOCK_DOCS = 1 << 13
BLOCK_TOKENS = 1 << 21
#: Pieces of text whose tokens a worker remembers, and how long they may be.
CACHE_PIECES = 120_000
CACHED_CHARACTERS = 40
#: Characters tokenized at once.
LOT_CHARACTERS = 500_000
#: A plane is a bitmap where it has this share of a block's documents, a list of them below.
DENSE_SHARE = 1 / 16

_DOC = pa.struct(
    [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
)
_PLANE = pa.struct([("digit", pa.int32()), ("dense", pa.binary()), ("bitmaps", pa.binary()), ("sparse", pa.binary()), ("lengths", pa.binary()), ("ordinals", pa.binary())])
_BLOCK = (
    "block bigint, docs array<struct<doc_id: bigint, n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string>>,"
    " pairs binary, planes array<struct<digit: int, dense: binary, bitmaps: binary, sparse: binary, lengths: binary, ordinals: binary>>, n_pairs bigint"
)

# Fixed value: where a byte-level tokenizer of this kind splits a text.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"


#: ``(n_a, n_b, links, groups)`` of a piece. A link is the ids of A and B as one 64-bit number,
#: groups are written as in their digest.
Part = tuple[int, int, bytes, str]


class PairTokenizer:
    """Both tokenizers over pieces of text, with what links their tokens.

    Texts are cut where a token of either kind must end, so that pieces repeat and are tokenized
    once. The byte tokenizer splits before white space that follows something else, before
    punctuation that follows a letter or digit, and after a lone line end. Where B's vocabulary
    has a piece across such a place, texts aren't cut there.
    """

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        with open(byte_path, encoding="utf-8") as file:
            model = json.load(file)
        letters = {letter: byte for byte, letter in _byte_letters().items()}
        vocabulary = model["model"]["vocab"]
        self.first_bytes = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if all(c in letters for c in token)}
        self.first_ids = self._byte_encoder(byte_path, model)
        self.second = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        shown = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(shown)]
        self.first_sizes = np.zeros(1 + max(self.first_bytes), dtype=np.int64)
        self.first_sizes[list(self.first_bytes)] = [len(data) for data in self.first_bytes.values()]
        self.second_sizes = np.array([len(data) for data in self.second_bytes])
        ids = range(max(len(self.first_sizes), len(shown)))
        self.digits = np.array([[f"{i}{after}" for i in ids] for after in (",", "|", ";", "")], dtype=object)
        self.cut = self._cut([p for i, p in enumerate(shown) if not self.second.is_byte(i)])
        #: B on a line end: what it puts before a piece that begins without a space.
        self.lead = self.second.encode("\n")
        self.line_end = self.first_ids("\n")[0]
        self.known: dict[str, Part | None] = {}
        self.older: dict[str, Part | None] = {}

    def _byte_encoder(self, path: str, model: dict) -> Callable[[str], list[int]]:
        """Ids of a text. Where merges are in the order of their ids, ids are ranks, and the
        encoder made for ranks gives the same ids several times as fast."""
        merges = [pair if isinstance(pair, str) else "".join(pair) for pair in model["model"]["merges"]]
        made = [model["model"]["vocab"][pair.replace(" ", "")] for pair in merges]
        plain = {key: model["pre_tokenizer"].get(key) for key in ("type", "add_prefix_space", "use_regex")}
        if made == sorted(made) and plain == {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True} and model["normalizer"] is None:
            ranks = {data: i for i, data in self.first_bytes.items()}
            return tiktoken.Encoding("bytes", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids

    @staticmethod
    def _cut(shown: list[str]) -> re.Pattern | None:
        if any("\n" in piece or re.search("[^▁]▁", piece) for piece in shown):
            return None
        inside = {after for piece in shown for before, after in zip(piece, piece[1:]) if before.isalnum()}
        free = "".join(re.escape(c) for c in _PUNCTUATION if c not in inside)
        return re.compile(rf"(?<=\S)(?=[ \n])|(?<=[^\W_])(?=[{free}])|(?<=\S\n)(?=\S)")

    def pieces(self, text: str) -> list[str]:
        """The text with the space that both tokenizers see before it, in pieces."""
        if not text:
            return []
        spaced = " " + text
        return [spaced] if self.cut is None else self.cut.split(spaced)

    def parts(self, texts: list[str]) -> list[list[Part | None]]:
        """The parts of each text, in order; None for a piece that the token bytes differ from."""
        if len(self.known) > CACHE_PIECES:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        cut = [self.pieces(text) for text in texts]
        joined, apart, long = [], [], []
        for piece in {piece for pieces in cut for piece in pieces if piece not in known}:
            if piece in older:
                known[piece] = older[piece]
            elif "\n" in piece or piece[-1].isspace() or self.cut is None:
                apart.append(piece)
            else:
                joined.append(piece)
            if len(piece) > CACHED_CHARACTERS:
                long.append(piece)
        if joined:
            known.update(zip(joined, self._parts(joined, *self._in_one(joined))))
        for piece in apart:
            known.update(zip([piece], self._parts([piece], *self._alone(piece))))
        found = [[known[piece] for piece in pieces] for pieces in cut]
        for piece in long:
            del known[piece]
        return found

    def _in_one(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of pieces tokenized as the lines of one text: no token reaches over a line end."""
        lines = "\n".join(pieces)
        first = self.first_ids(lines)
        return _split(first, self.line_end), _split(self.second.encode("\n" + lines)[len(self.lead) :], self.lead[-1])

    def _alone(self, piece: str) -> tuple[list[list[int]], list[list[int]]]:
        first = self.first_ids(piece)
        if piece[0] == " " != piece:
            return [first], [self.second.encode(piece[1:])]
        return [first], [self.second.encode("\n" + piece)[len(self.lead) :]]

    def _parts(self, pieces: list[str], first: list[list[int]], second: list[list[int]]) -> list[Part | None]:
        """Links and groups of many pieces at once; end to end, their ends are token ends too."""
        if not len(pieces) == len(first) == len(second):  # not one line each after all
            return [self._parts([piece], *self._alone(piece))[0] for piece in pieces]
        good = [self._covers(piece, a, b) for piece, a, b in zip(pieces, first, second)]
        if not any(good):
            return [None] * len(pieces)
        sizes = np.array([len(piece.encode()) for piece, fine in zip(pieces, good) if fine])
        n_a = np.array([len(ids) for ids, fine in zip(first, good) if fine])
        n_b = np.array([len(ids) for ids, fine in zip(second, good) if fine])
        a = np.array([i for ids, fine in zip(first, good) if fine for i in ids], dtype=np.int64)
        b = np.array([i for ids, fine in zip(second, good) if fine for i in ids], dtype=np.int64)
        a_ends, b_ends = np.cumsum(self.first_sizes[a]), np.cumsum(self.second_sizes[b])
        ends, common = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends)
        links = (a[np.searchsorted(a_ends, ends)] << 32 | b[np.searchsorted(b_ends, ends)]).tobytes()
        last = np.cumsum(sizes)
        link_stops = 8 * (np.searchsorted(ends, last) + 1)
        # Written out group by group, A's ids before B's, each with what follows it.
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        a_place = np.arange(len(a)) + np.searchsorted(b_group, a_group)
        b_place = np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")
        words = np.empty(len(a) + len(b), dtype=object)
        words[a_place] = self.digits[np.where(a_ends == common[a_group], 1, 0), a]
        words[b_place] = self.digits[np.where(np.isin(b_ends, last), 3, np.where(b_ends == common[b_group], 2, 0)), b]
        words = words.tolist()
        word_stops = np.cumsum(n_a + n_b).tolist()
        link_start = word_start = 0
        made = []
        for x, y, link_stop, word_stop in zip(n_a.tolist(), n_b.tolist(), link_stops.tolist(), word_stops):
            made.append((x, y, links[link_start:link_stop], "".join(words[word_start:word_stop])))
            link_start, word_start = link_stop, word_stop
        parts = iter(made)
        return [next(parts) if fine else None for fine in good]

    def _covers(self, piece: str, a: list[int], b: list[int]) -> bool:
        data = piece.encode()
        first, second = self.first_bytes, self.second_bytes
        return b"".join([first[i] for i in a]) == data and b"".join([second[i] for i in b]) == data


def _split(ids: list[int], at: int) -> list[list[int]]:
    """The ids between those that equal ``at``."""
    parts, start = [], 0
    array = np.array(ids)
    for stop in np.flatnonzero(array == at).tolist():
        parts.append(ids[start:stop])
        start = stop + 1
    parts.append(ids[start:])
    return parts


@lru_cache(maxsize=1)
def pair_tokenizer(byte_path: str, piece_path: str) -> PairTokenizer:
    """One per worker process, so that what it remembers outlives a task."""
    return PairTokenizer(byte_path, piece_path)


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    A (``byte_path``, a byte-level BPE file) reads a space and the text, B (``piece_path``, a
    SentencePiece model) the text, to which it adds the space; neither adds special tokens, and
    their strings inside a text are text. Null and empty texts, and those whose token bytes differ
    from space and text, have no tokens: zeros and an empty string. ``count`` of a pair of ids is
    the number of links between them in all rows; ``n_best`` are a row's links whose count is the
    highest of their B id, ties included, ``count_sum`` adds the counts of all its links. Repeated
    rows count and are returned as often as they are there; other columns are not read. One
    document is held in memory as a whole.
    """
    packed = stored(blocks(docs, byte_path, piece_path), "pair-blocks")
    told = exchange.answers(_questions(packed), _best_of_second)
    return _scores(packed, told)


def pair_counts(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """``a, b, links, documents`` of every pair of ids linked anywhere."""
    packed = stored(blocks(docs, byte_path, piece_path), "pair-blocks")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64()), ("documents", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, postings = _opened(row, len(row["docs"]))
                links, documents = postings.counts()
                a, b = pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a, b, links, documents)], schema=schema)

    partial = packed.mapInArrow(run, "a bigint, b bigint, links bigint, documents bigint")
    return partial.groupBy("a", "b").agg(F.sum("links").alias("links"), F.sum("documents").alias("documents"))


def blocks(docs: DataFrame, byte_path: str, piece_path: str, docs_per_block: int = BLOCK_DOCS) -> DataFrame:
    """One row per block: its documents, its pairs, and the pairs' postings as planes."""
    prepare(docs.sparkSession)
    schema = pa.schema(
        [("block", pa.int64()), ("docs", pa.list_(_DOC)), ("pairs", pa.binary()), ("planes", pa.list_(_PLANE)), ("n_pairs", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = pair_tokenizer(byte_path, piece_path)
        made = TaskContext.get().partitionId() << 32
        rows: list[dict] = []
        held: list[np.ndarray] = []
        tokens = 0
        for few in _few_at_once(batches):
            for doc_id, parts in zip([doc_id for doc_id, _ in few], tokenizer.parts([text for _, text in few])):
                row, links = _document(doc_id, parts)
                rows.append(row)
                held.append(links)
                tokens += len(links)
                if len(rows) == docs_per_block or tokens >= BLOCK_TOKENS:
                    yield packed(made, rows, held)
                    made, rows, held, tokens = made + 1, [], [], 0
        if rows:
            yield packed(made, rows, held)

    def packed(block: int, rows: list[dict], held: list[np.ndarray]) -> pa.RecordBatch:
        pairs, postings = Postings.of(held)
        row = {"block": block, "docs": rows, "pairs": exchange.planes(pairs), "planes": postings.packed(), "n_pairs": len(pairs)}
        return pa.RecordBatch.from_pylist([row], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _BLOCK)


def _few_at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str]]]:
    """Documents in lots of some ``LOT_CHARACTERS``; null texts as empty ones."""
    few, characters = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            few.append((doc_id, text or ""))
            characters += len(few[-1][1])
            if characters >= LOT_CHARACTERS:
                yield few
                few, characters = [], 0
    if few:
        yield few


def _document(doc_id: int | None, parts: list[Part | None]) -> tuple[dict, np.ndarray]:
    """The columns of one document that don't depend on others, and its links."""
    if not parts or None in parts:
        row = {"doc_id": doc_id, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": ""}
        return row, np.empty(0, dtype=np.uint64)
    n_a, n_b, links, groups = zip(*parts)
    links = np.frombuffer(b"".join(links), dtype=np.uint64)
    row = {
        "doc_id": doc_id,
        "n_a": sum(n_a),
        "n_b": sum(n_b),
        # Every token end begins a new link, and a common one a new group.
        "n_groups": sum(n_a) + sum(n_b) - len(links),
        "n_links": len(links),
        "groups_sha256": hashlib.sha256(";".join(groups).encode()).hexdigest(),
    }
    return row, links


@dataclass
class Plane:
    """Per pair the documents whose multiplicity has this binary digit: bitmaps, and lists of few."""

    digit: int
    dense: np.ndarray  # pairs with a bitmap
    bitmaps: np.ndarray  # dense pairs x bytes
    sparse: np.ndarray  # pairs with a list
    lengths: np.ndarray
    ordinals: np.ndarray  # the lists, one after another

    def held(self) -> tuple[np.ndarray, np.ndarray]:
        """``(pair, document)`` of everything in the plane."""
        place, document = np.nonzero(np.unpackbits(self.bitmaps, axis=1, bitorder="little"))
        return (
            np.concatenate([self.dense[place], np.repeat(self.sparse, self.lengths)]),
            np.concatenate([document, self.ordinals.astype(np.int64)]),
        )


class Postings:
    def __init__(self, planes: list[Plane], pairs: int, docs: int):
        self.planes, self.pairs, self.docs = planes, pairs, docs

    @classmethod
    def of(cls, links: list[np.ndarray]) -> tuple[np.ndarray, Postings]:
        """The distinct pairs of a block in the order buckets have them, and their postings."""
        docs = len(links)
        document = np.repeat(np.arange(docs, dtype=np.uint64), [len(own) for own in links])
        every, places = np.unique(np.concatenate(links) if links else np.empty(0, np.uint64), return_inverse=True)
        turned = _turned(every)
        order = np.argsort(turned)
        rank = np.empty(len(every), dtype=np.uint64)
        rank[order] = np.arange(len(every), dtype=np.uint64)
        at, often = np.unique(rank[places] << np.uint64(32) | document, return_counts=True)
        pair, document = (at >> np.uint64(32)).astype(np.int64), (at & np.uint64(0xFFFFFFFF)).astype(np.int64)
        planes = []
        for digit in range(int(often.max(initial=0)).bit_length()):
            has = often >> digit & 1 == 1
            planes.append(_plane(digit, pair[has], document[has], len(every), docs))
        return every[order], cls(planes, len(every), docs)

    def packed(self) -> list[dict]:
        return [
            {
                "digit": p.digit,
                "dense": exchange.planes(p.dense, 4),
                "bitmaps": p.bitmaps.tobytes(),
                "sparse": exchange.planes(p.sparse, 4),
                "lengths": exchange.planes(p.lengths, 4),
                "ordinals": p.ordinals.astype("<u2").tobytes(),
            }
            for p in self.planes
        ]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Links and documents of every pair, by counting bits."""
        links = np.zeros(self.pairs, dtype=np.int64)
        few = []
        many: dict[int, np.ndarray] = {}
        for plane in self.planes:
            links[plane.dense] += np.bitwise_count(plane.bitmaps).sum(axis=1, dtype=np.int64) << plane.digit
            links[plane.sparse] += plane.lengths << plane.digit
            few.append(np.repeat(plane.sparse, plane.lengths) << 32 | plane.ordinals.astype(np.int64))
            for pair, bitmap in zip(plane.dense.tolist(), plane.bitmaps):
                many[pair] = many[pair] | bitmap if pair in many else bitmap
        listed = np.unique(np.concatenate(few)) if few else np.empty(0, dtype=np.int64)
        alone = np.full(len(listed), True)
        for pair, bitmap in many.items():  # a pair may be listed in one plane and mapped in another
            start, stop = np.searchsorted(listed, [pair << 32, (pair + 1) << 32])
            own = listed[start:stop] & 0xFFFFFFFF
            alone[start:stop] = bitmap[own >> 3] >> (own & 7).astype(np.uint8) & 1 == 0
        documents = np.bincount(listed[alone] >> 32, minlength=self.pairs)
        for pair, bitmap in many.items():
            documents[pair] += int(np.bitwise_count(bitmap).sum())
        return links, documents

    def scores(self, count: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per document the sum of its links' counts, and how many links are the best of their id."""
        total, top = np.zeros(self.docs, dtype=np.int64), np.zeros(self.docs, dtype=np.int64)
        for plane in self.planes:
            pair, document = plane.held()
            np.add.at(total, document, count[pair] << plane.digit)
            np.add.at(top, document, best[pair] << plane.digit)
        return total, top


def _plane(digit: int, pair: np.ndarray, document: np.ndarray, pairs: int, docs: int) -> Plane:
    """``pair`` and ``document`` in order."""
    size = np.bincount(pair, minlength=pairs)
    crowded = size >= max(2, docs * DENSE_SHARE)
    dense, sparse = np.flatnonzero(crowded), np.flatnonzero(~crowded & (size > 0))
    place = np.zeros(pairs, dtype=np.int64)
    place[dense] = np.arange(len(dense))
    inside = crowded[pair]
    bits = np.zeros((len(dense), -(-docs // 8)), dtype=np.uint8)
    np.bitwise_or.at(bits, (place[pair[inside]], document[inside] >> 3), (1 << (document[inside] & 7)).astype(np.uint8))
    return Plane(digit, dense, bits, sparse, size[sparse], document[~inside].astype(np.uint16))


def _opened(row: dict, docs: int) -> tuple[np.ndarray, Postings]:
    pairs = exchange.numbers(row["pairs"])
    planes = []
    for p in row["planes"]:
        dense = exchange.numbers(p["dense"], 4).astype(np.int64)
        planes.append(
            Plane(
                p["digit"],
                dense,
                np.frombuffer(p["bitmaps"], dtype=np.uint8).reshape(len(dense), -(-docs // 8)),
                exchange.numbers(p["sparse"], 4).astype(np.int64),
                exchange.numbers(p["lengths"], 4).astype(np.int64),
                np.frombuffer(p["ordinals"], dtype="<u2"),
            )
        )
    return pairs, Postings(planes, len(pairs), docs)


def _turned(pairs: np.ndarray) -> np.ndarray:
    """Keys of the exchange: pairs of one second id side by side, second ids spread evenly."""
    second = (pairs * np.uint64(0x9E3779B1)) << np.uint64(32)
    return second | pairs >> np.uint64(32)


def _questions(packed: DataFrame) -> DataFrame:
    asked = packed.agg(F.sum("n_pairs")).first()[0] or 0
    bounds = exchange.even_bounds(exchange.bucket_count(asked))
    schema = pa.schema(
        [("block", pa.int64()), ("held", pa.bool_()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pairs, postings = _opened(row, row["n_docs"])
                counts = np.stack(postings.counts(), axis=1)
                rows = list(exchange.questions(row["block"], False, 1, _turned(pairs), counts, bounds))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return packed.select("block", "pairs", "planes", F.size("docs").alias("n_docs")).mapInArrow(run, exchange.QUESTIONS)


def _best_of_second(keys: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Each pair's links, and 1 where no other pair of its second id has more."""
    second = keys >> np.uint64(32)
    starts = np.flatnonzero(np.r_[True, second[1:] != second[:-1]])
    most = np.repeat(np.maximum.reduceat(totals[:, 0], starts), np.diff(np.r_[starts, len(keys)]))
    return np.stack([totals[:, 0], totals[:, 0] == most], axis=1)


_SCORES = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _scores(packed: DataFrame, told: DataFrame) -> DataFrame:
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        _, postings = _opened(row, len(row["docs"]))
        answer = exchange.put_together(answers, 1, 2)
        total, best = postings.scores(answer[:, 0], answer[:, 1])
        docs = pa.Table.from_struct_array(pa.array(row["docs"], _DOC))
        columns = {name: docs[name] for name in docs.column_names} | {"n_best": pa.array(best), "count_sum": pa.array(total)}
        return pa.table({name.split()[0]: columns[name.split()[0]] for name in _SCORES.split(", ")})

    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, _SCORES)
