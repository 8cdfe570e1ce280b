"""Scoring texts by deleted interpolation.

Maximum-likelihood estimates of n-grams of all orders are mixed, from the longest down to the
uniform distribution. How much a context is trusted depends on how often it was seen: contexts
fall into buckets by the binary logarithm of their frequency, and each order and bucket has a
mixture weight. The weights are learned by expectation-maximisation on held-out documents, whose
own counts are deleted from the estimates that predict them; the final estimates use all training
documents.

Documents are packed into blocks of word numbers. Blocks ask for the corpus-wide counts of their
distinct n-grams through :mod:`millrace.llm.exchange` and then predict every word from the answers
alone, so nothing of the size of the vocabulary is ever in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import exchange
from millrace.llm.tables import prepare, stored
from millrace.llm.words import mixed, text_hashes

#: Longest n-grams.
ORDER = 2
#: Words of one block; a longer document is a block of its own.
BLOCK_WORDS = 1 << 20
#: Questions of a block that are handed on together.
QUESTIONS_AT_ONCE = 64
#: Tokens whose estimates are mixed together.
TOKENS_AT_ONCE = 1 << 16
#: One in so many training documents is held out while the weights are learned.
FOLDS = 10
#: Contexts by the bits of their frequency.
BUCKETS = 64
#: Rounds of expectation-maximisation, ended earlier once the text's probability stands still.
ROUNDS = 30
SETTLED = 1e-6
#: Digits of a weight that are kept: the order of additions doesn't show.
DIGITS = 9

# Neither is the hash of a word in practice: words have 64-bit hashes.
_END = np.uint64(0x5DEECE66D1234567)
_BEGIN = np.uint64(0x2545F4914F6CDD1D)
_STEP = np.uint64(0x9E3779B97F4A7C15)

# How a document counts.
SCORED, TRAINING, FOLD = 0, 1, 2

_BLOCK = (
    "block bigint, held boolean, doc_ids array<bigint>, roles binary, lengths binary, vocabulary binary, words binary,"
    " training_tokens bigint, fold_tokens bigint, training_docs bigint, fold_docs bigint, tokens bigint"
)


@dataclass(frozen=True)
class Corpus:
    """Sizes of the training documents, and of the held-out part of them."""

    tokens: int
    fold_tokens: int
    docs: int
    fold_docs: int
    types: int


def score(docs: DataFrame, training: Column, order: int = ORDER) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    A text is its words (A-Z lowered, cut at ASCII white space) and one end; null is an empty
    text, which is the end alone. Models are fitted on the rows where ``training`` is true (null
    is false), all of them. ``base_score`` is the smoothed unigram model, ``score`` the mixture;
    both are sums of log10 over the tokens. Without training rows all tokens are equally likely.
    Repeated rows count and are returned as often as they are there; other columns than ``doc_id``
    and ``text`` are read only by ``training``. Words are told apart by 64-bit hashes. One
    document is held in memory as a whole.
    """
    prepare(docs.sparkSession)
    packed = stored(blocks(docs, training), "word-blocks", large_rows=True)
    told = stored(exchange.answers(_questions(packed, order), lambda keys, totals: totals), "gram-counts", large_rows=True)
    corpus = _corpus(packed, told)
    weights = learned_weights(packed.where("held"), told.where("held"), corpus, order)
    return _scores(packed, told, corpus, weights)


def blocks(docs: DataFrame, training: Column, words_per_block: int = BLOCK_WORDS) -> DataFrame:
    """Documents as word numbers, many to a row. Blocks of held-out documents hold no others."""
    fold = F.abs(F.xxhash64(F.col("doc_id").cast("bigint"))) % FOLDS == 0
    role = F.when(~F.coalesce(training, F.lit(False)), SCORED).when(fold, FOLD).otherwise(TRAINING)
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("held", pa.bool_()),
            ("doc_ids", pa.list_(pa.int64())),
            ("roles", pa.binary()),
            ("lengths", pa.binary()),
            ("vocabulary", pa.binary()),
            ("words", pa.binary()),
            *((name, pa.int64()) for name in ("training_tokens", "fold_tokens", "training_docs", "fold_docs", "tokens")),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        waiting: dict[bool, list[tuple]] = {False: [], True: []}
        filled = {False: 0, True: 0}
        for batch in batches:
            for doc_id, text, own in zip(*(column.to_pylist() for column in batch.columns)):
                held = own == FOLD
                hashes = np.append(text_hashes(text or ""), _END)
                waiting[held].append((doc_id, own, hashes))
                filled[held] += len(hashes)
                if filled[held] >= words_per_block:
                    yield packed(made, held, waiting[held])
                    made, waiting[held], filled[held] = made + 1, [], 0
        for held, rows in waiting.items():
            if rows:
                yield packed(made, held, rows)
                made += 1

    def packed(block: int, held: bool, rows: list[tuple]) -> pa.RecordBatch:
        doc_ids, roles, hashes = zip(*rows)
        roles = np.array(roles, dtype=np.uint8)
        lengths = np.array([len(own) for own in hashes])
        vocabulary, numbered = np.unique(np.concatenate(hashes), return_inverse=True)
        trains, folds = roles >= TRAINING, roles == FOLD
        row = {
            "block": block,
            "held": held,
            "doc_ids": list(doc_ids),
            "roles": roles.tobytes(),
            "lengths": exchange.planes(lengths),
            "vocabulary": exchange.planes(vocabulary),
            "words": exchange.planes(numbered, 4),
            "training_tokens": int(lengths[trains].sum()),
            "fold_tokens": int(lengths[folds].sum()),
            "training_docs": int(trains.sum()),
            "fold_docs": int(folds.sum()),
            "tokens": int(lengths.sum()),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), "text", role.alias("role")).mapInArrow(run, _BLOCK)


@dataclass
class Block:
    """The tokens of a block, and where its documents begin and end."""

    hashes: np.ndarray
    roles: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        vocabulary = exchange.numbers(row["vocabulary"])
        hashes = vocabulary[exchange.numbers(row["words"], 4).astype(np.int64)]
        return cls(hashes, np.frombuffer(row["roles"], dtype=np.uint8), exchange.numbers(row["lengths"]).astype(np.int64))

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def grams(self, order: int) -> Iterator[np.ndarray]:
        """For each order from 1 on, a key of the n-gram that ends at each token."""
        starts = self.starts
        keys, before = self.hashes, self.hashes
        yield mixed(keys ^ _STEP)
        for size in range(2, order + 1):
            before = np.roll(before, 1)
            # What stands before a document is its beginning, however far back one looks.
            offset = np.minimum(self.lengths, size - 1)
            for back in range(size - 1):
                before[starts[offset > back] + back] = _BEGIN
            keys = mixed(keys * _STEP ^ before)
            yield mixed(keys ^ np.uint64(size))


def _questions(packed: DataFrame, order: int) -> DataFrame:
    tokens = packed.agg(F.sum("tokens")).first()[0] or 0
    bounds = exchange.even_bounds(exchange.bucket_count(tokens))
    schema = pa.schema(
        [("block", pa.int64()), ("held", pa.bool_()), ("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                row = batch.slice(place, 1).to_pylist()[0]
                block = Block.of(row)
                roles = np.repeat(block.roles, block.lengths)
                for size, grams in enumerate(block.grams(order), 1):
                    keys, places = np.unique(grams, return_inverse=True)
                    counts = np.stack(
                        [np.bincount(places[roles >= TRAINING], minlength=len(keys)), np.bincount(places[roles == FOLD], minlength=len(keys))],
                        axis=1,
                    )
                    del grams, places
                    asked = exchange.questions(row["block"], row["held"], size, keys, counts, bounds)
                    while rows := list(islice(asked, QUESTIONS_AT_ONCE)):
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return packed.select("block", "held", "roles", "lengths", "vocabulary", "words").mapInArrow(run, exchange.QUESTIONS)


def _corpus(packed: DataFrame, told: DataFrame) -> Corpus:
    sizes = packed.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("training_tokens", "fold_tokens", "training_docs", "fold_docs"))).first()
    types = told.where("kind = 1").agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    return Corpus(sizes["training_tokens"], sizes["fold_tokens"], sizes["training_docs"], sizes["fold_docs"], types)


def _estimates(block: Block, told: pa.Table, corpus: Corpus, order: int, deleted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimates and context buckets of every token (tokens x orders), and unigram counts.

    With ``deleted``, what the held-out documents added is taken out again. Bucket 0 is a context
    that was never seen.
    """
    n, starts = len(block.hashes), block.starts
    estimates = np.zeros((n, order))
    buckets = np.zeros((n, order), dtype=np.int8)
    shorter = known = None
    for size, grams in enumerate(block.grams(order), 1):
        places = _places(grams)
        del grams
        answer = exchange.put_together(told, size, 2)
        counts = (answer[:, 0] - answer[:, 1] if deleted else answer[:, 0])[places]
        if size == 1:
            known = answer[:, 0][places] if deleted else counts
            context = np.full(n, corpus.tokens - (corpus.fold_tokens if deleted else 0))
        else:
            # How often the n-1 tokens before were followed by anything.
            context = np.roll(shorter, 1)
            context[starts] = corpus.docs - (corpus.fold_docs if deleted else 0)
        del places, answer
        np.divide(counts, context, out=estimates[:, size - 1], where=context > 0)
        buckets[:, size - 1] = np.frexp(context.astype(np.float64))[1]
        shorter = counts
    return estimates, buckets, known


def _places(keys: np.ndarray) -> np.ndarray:
    """``np.unique``'s inverse, in little memory."""
    order = np.argsort(keys)
    ranked = keys[order]
    places = np.empty(len(keys), dtype=np.int64 if len(keys) >> 31 else np.int32)
    places[order] = np.cumsum(np.append(False, ranked[1:] != ranked[:-1]), dtype=places.dtype)
    return places


def mixture(estimates: np.ndarray, buckets: np.ndarray, weights: np.ndarray, types: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Probabilities of tokens, and the share of the mixture that each order adds to them.

    ``weights[order - 1][bucket]`` is the share of an order's own estimate; the rest goes to the
    next shorter one, and at last to the uniform distribution over all types and one unknown.
    """
    left = np.ones(len(estimates))
    shares = []
    for place in range(estimates.shape[1] - 1, -1, -1):
        weight = weights[place][buckets[:, place]]
        shares.append(left * weight * estimates[:, place])
        left = left * (1 - weight)
    shares.append(left / (types + 1))
    return np.sum(shares, axis=0), shares


def _cogrouped(packed: DataFrame, told: DataFrame, run, ddl: str) -> DataFrame:
    return packed.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, ddl)


def learned_weights(packed: DataFrame, told: DataFrame, corpus: Corpus, order: int, rounds: int = ROUNDS) -> np.ndarray:
    """Mixture weights by expectation-maximisation over the held-out blocks.

    Every round is one pass over stored estimates and brings as many rows to the driver as there
    are orders and buckets. A bucket nothing was held out for keeps one half.
    """
    names = [f"estimate{size}" for size in range(1, order + 1)] + [f"bucket{size}" for size in range(1, order + 1)]
    schema = pa.schema([(name, pa.float64() if name.startswith("e") else pa.int8()) for name in names] + [("n", pa.int64())])

    def observed(block: pa.Table, answers: pa.Table) -> pa.Table:
        estimates, buckets, _ = _estimates(Block.of(block.to_pylist()[0]), answers, corpus, order, deleted=True)
        columns = [*estimates.T, *buckets.T]
        alike = np.zeros(len(estimates), dtype=np.uint64)
        for column in columns:
            column = np.ascontiguousarray(column)
            alike = mixed(alike * _STEP ^ (column.view(np.uint64) if column.itemsize == 8 else column.astype(np.uint64)))
        _, first, n = np.unique(alike, return_index=True, return_counts=True)
        return pa.table([pa.array(c[first]).cast(f.type) for c, f in zip(columns, schema)] + [pa.array(n)], schema=schema)

    ddl = ", ".join(f"{name} {'double' if name.startswith('e') else 'tinyint'}" for name in names) + ", n bigint"
    seen = stored(_cogrouped(packed.drop("held"), told, observed, ddl), "held-out")
    weights = np.full((order, BUCKETS), 0.5)
    weights[:, 0] = 0
    before = None
    for _ in range(rounds):
        share, reached, likelihood = _expected(seen, weights, order, corpus.types)
        used = reached > 0
        used[:, 0] = False
        weights[used] = np.round((share[used] + 1) / (reached[used] + 2), DIGITS)
        if before is not None and likelihood - before <= SETTLED * abs(before):
            break
        before = likelihood
    return weights


def _expected(seen: DataFrame, weights: np.ndarray, order: int, types: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Per order and bucket: expected tokens drawn from it, and those that came that far down."""
    schema = pa.schema([("place", pa.int32()), ("bucket", pa.int32()), ("share", pa.float64()), ("reached", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, reached = np.zeros((order, BUCKETS)), np.zeros((order, BUCKETS))
        likelihood = 0.0
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False) for column in batch.columns]
            estimates = np.stack(columns[:order], axis=1)
            buckets = np.stack(columns[order : 2 * order], axis=1).astype(np.int64)
            n = columns[-1].astype(np.float64)
            chance, shares = mixture(estimates, buckets, weights, types)
            likelihood += float((n * np.log10(chance)).sum())
            left = n.copy()
            for place, own in zip(range(order - 1, -1, -1), shares):
                drawn = n * own / chance
                reached[place] += np.bincount(buckets[:, place], left, BUCKETS)
                share[place] += np.bincount(buckets[:, place], drawn, BUCKETS)
                left = left - drawn
        rows = [
            {"place": place, "bucket": bucket, "share": share[place][bucket], "reached": reached[place][bucket]}
            for place in range(order)
            for bucket in range(BUCKETS)
            if reached[place][bucket]
        ]
        yield pa.RecordBatch.from_pylist([*rows, {"place": -1, "bucket": 0, "share": likelihood, "reached": 0.0}], schema=schema)

    sums = seen.mapInArrow(run, "place int, bucket int, share double, reached double").groupBy("place", "bucket").agg(
        F.sum("share").alias("share"), F.sum("reached").alias("reached")
    )
    share, reached, likelihood = np.zeros((order, BUCKETS)), np.zeros((order, BUCKETS)), 0.0
    for row in sums.collect():  # at most order x BUCKETS + 1
        if row["place"] < 0:
            likelihood = row["share"]
        else:
            share[row["place"]][row["bucket"]] = row["share"]
            reached[row["place"]][row["bucket"]] = row["reached"]
    return share, reached, likelihood


_SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scores(packed: DataFrame, told: DataFrame, corpus: Corpus, weights: np.ndarray) -> DataFrame:
    order = len(weights)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
    )

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        row = rows.to_pylist()[0]
        block = Block.of(row)
        estimates, buckets, known = _estimates(block, answers, corpus, order, deleted=False)
        parts = (slice(at, at + TOKENS_AT_ONCE) for at in range(0, len(known), TOKENS_AT_ONCE))
        logs = np.concatenate([np.log10(mixture(estimates[part], buckets[part], weights, corpus.types)[0]) for part in parts])
        base = np.log10((known + 0.5) / (corpus.tokens + 0.5 * (corpus.types + 1)))
        starts = block.starts
        return pa.table(
            [
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(block.lengths),
                pa.array(np.add.reduceat((known > 0).astype(np.int64), starts)),
                pa.array(np.full(len(starts), corpus.tokens)),
                pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(logs, starts)),
            ],
            schema=schema,
        )

    return _cogrouped(packed.select("block", "doc_ids", "roles", "lengths", "vocabulary", "words"), told, run, _SCORES)
