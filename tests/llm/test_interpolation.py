import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.llm import exchange, interpolation, queries
from millrace.llm.words import text_hashes, word_hashes, words

SF_DIR = "/root/testdata/sf0.001"
END, BEGIN = "</end>", "<begin>"


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", text) + [END]


def grams(words, order):
    padded = [BEGIN] * (order - 1) + words
    return [tuple(padded[i : i + order]) for i in range(len(words))]


class Plain:
    """Dictionaries over all training texts; the weights are given."""

    def __init__(self, texts, order):
        self.order, self.docs = order, len(texts)
        self.counts = [Counter(g for t in texts for g in grams(tokens(t), k)) for k in range(1, order + 1)]
        self.n = sum(self.counts[0].values())
        self.types = len(self.counts[0])

    def estimates(self, text):
        for i in range(len(words := tokens(text))):
            row = []
            for k in range(1, self.order + 1):
                gram = grams(words, k)[i]
                if k == 1:
                    context = self.n
                elif set(gram[:-1]) == {BEGIN}:
                    context = self.docs
                else:
                    context = self.counts[k - 2][gram[:-1]]
                row.append((self.counts[k - 1][gram] / context if context else 0.0, context.bit_length()))
            yield row

    def score(self, text, weights):
        total = 0.0
        for row in self.estimates(text):
            p = 1 / (self.types + 1)
            for k, (estimate, bucket) in enumerate(row):
                p = weights[k][bucket] * estimate + (1 - weights[k][bucket]) * p
            total += math.log10(p)
        return total

    def base(self, text):
        return sum(math.log10((self.counts[0][(w,)] + 0.5) / (self.n + 0.5 * (self.types + 1))) for w in tokens(text))


def plain_weights(kept, held, order, types, rounds=interpolation.ROUNDS):
    """Expectation-maximisation token by token."""
    rows = [row for text in held for row in kept.estimates(text)]
    weights = np.full((order, interpolation.BUCKETS), 0.5)
    weights[:, 0] = 0
    before = None
    for _ in range(rounds):
        share, reached = np.zeros_like(weights), np.zeros_like(weights)
        likelihood = 0.0
        for row in rows:
            parts, left = [], 1.0
            for k in range(order - 1, -1, -1):
                estimate, bucket = row[k]
                parts.append((k, bucket, left * weights[k][bucket] * estimate))
                left *= 1 - weights[k][bucket]
            chance = sum(p for *_, p in parts) + left / (types + 1)
            likelihood += math.log10(chance)
            remains = 1.0
            for k, bucket, part in parts:
                reached[k][bucket] += remains
                share[k][bucket] += part / chance
                remains -= part / chance
        used = reached > 0
        used[:, 0] = False
        weights[used] = np.round((share[used] + 1) / (reached[used] + 2), interpolation.DIGITS)
        if before is not None and likelihood - before <= interpolation.SETTLED * abs(before):
            break
        before = likelihood
    return weights


def in_fold(spark, ids):
    frame = spark.createDataFrame([(i,) for i in ids], "i bigint").withColumn("h", F.abs(F.xxhash64("i")) % interpolation.FOLDS == 0)
    return {r["i"] for r in frame.collect() if r["h"]}


def corpus(n=120, seed=0):
    rng = np.random.default_rng(seed)
    names = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(n):
        at, words = int(rng.integers(40)), []
        for _ in range(int(rng.integers(0, 40))):
            at = (at * 3 + int(rng.integers(4))) % 40
            words.append(names[at].upper() if rng.random() < 0.1 else names[at])
        texts.append(" ".join(words))
    return list(enumerate(texts))


def training(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 != 1


def rule():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1


@pytest.mark.parametrize("order", [1, 2, 3])
def test_equals_plain_interpolation(spark, documents, order):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "never seen words here"), (1003, "a" * 50_000), (5, corpus()[5][1])]
    got = {(r["doc_id"], r["n_tokens"]): r for r in interpolation.score(documents(rows), rule(), order).collect()}
    texts = [t for i, t in rows if training(i)]
    fold = in_fold(spark, [i for i, _ in rows])
    full = Plain(texts, order)
    kept = Plain([t for i, t in rows if training(i) and i not in fold], order)
    weights = plain_weights(kept, [t for i, t in rows if training(i) and i in fold], order, full.types)
    assert len(fold) > 3 and len(got) == len({(i, len(tokens(t))) for i, t in rows})
    for i, text in rows:
        row = got[i, len(tokens(text))]
        assert row["train_tokens"] == full.n
        assert row["n_known"] == sum((w,) in full.counts[0] for w in tokens(text))
        assert row["base_score"] == pytest.approx(full.base(text), rel=1e-9)
        assert row["score"] == pytest.approx(full.score(text, weights), rel=1e-7)


def test_blocks_do_not_matter(spark, documents, monkeypatch):
    rows = corpus(60)
    whole = sorted(map(tuple, interpolation.score(documents(rows), rule()).collect()))
    parts = interpolation.blocks(documents(rows), rule(), words_per_block=30)
    assert parts.count() > 20
    blocks = interpolation.blocks
    monkeypatch.setattr(interpolation, "blocks", lambda docs, given: blocks(docs, given, words_per_block=30))
    cut = sorted(map(tuple, interpolation.score(documents(rows), rule()).collect()))
    assert [r[:4] for r in cut] == [r[:4] for r in whole]
    assert [r[4:] for r in cut] == [pytest.approx(r[4:], rel=1e-9) for r in whole]


def test_no_training_and_no_rows(spark, documents, clash):
    rows = [(1, "a b"), (2, None)]
    got = interpolation.score(clash(documents(rows)), F.lit(False)).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got) == [
        (1, 3, 0, 0, 0.0, 0.0),
        (2, 1, 0, 0, 0.0, 0.0),
    ]
    assert interpolation.score(documents([]), rule()).collect() == []
    null_id = interpolation.score(documents([(None, "a"), (1, "a")]), F.lit(True)).collect()
    assert sorted((r["doc_id"] is None, r["n_known"]) for r in null_id) == [(False, 2), (True, 2)]


def test_context_beats_single_words(documents):
    got = interpolation.score(documents(corpus(300)), rule()).collect()
    held = [r for r in got if not training(r["doc_id"])]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) * 0.75


def test_hashes_from_bytes():
    for text in ("", "  A b\tC\nd\x0bE\x0cf\rg ", "É é ẞ İ\u2003x\x1cy\x85z \ud800", "日本 語"):
        assert text_hashes(text).tolist() == word_hashes(words(text)).tolist()


def test_planes():
    numbers = np.array([0, 1, 255, 256, 2**40, 2**64 - 1], dtype=np.uint64)
    assert (exchange.numbers(exchange.planes(numbers)) == numbers).all()
    assert [exchange.bucket_count(n) for n in (0, 64 << 20, (64 << 20) + 1)] == [64, 64, 128]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_query_equals_plain_interpolation(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    rows = list(zip(docs["doc_id"], docs["text"]))
    got = {r["doc_id"]: r for r in queries.op13_interpolation(spark, SF_DIR).collect()}
    fold = in_fold(spark, docs["doc_id"])
    order = interpolation.ORDER
    full = Plain([t for i, t in rows if training(i)], order)
    kept = Plain([t for i, t in rows if training(i) and i not in fold], order)
    weights = plain_weights(kept, [t for i, t in rows if training(i) and i in fold], order, full.types)
    assert len(got) == len(rows)
    for i, text in rows:
        assert got[i]["held_out"] == (not training(i)) and got[i]["train_tokens"] == full.n
        assert got[i]["n_tokens"] == len(tokens(text))
        assert got[i]["base_score"] == pytest.approx(full.base(text), rel=1e-9)
        assert got[i]["score"] == pytest.approx(full.score(text, weights), rel=1e-6)
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_answers_in_the_fewest_bytes():
    for numbers, size in (([0], 1), ([255, 3], 1), ([256, 0, 7], 2), ([1 << 23], 3), ([(1 << 64) - 1, 5], 8)):
        data = exchange.fewest(np.array(numbers, dtype=np.uint64))
        assert exchange.from_fewest(data).tolist() == numbers
        assert len(data) == 1 + len(numbers) * size


def test_places_are_the_inverse_of_unique():
    keys = np.array([5, 2**64 - 1, 5, 0, 7, 0], dtype=np.uint64)
    assert interpolation._places(keys).tolist() == np.unique(keys, return_inverse=True)[1].tolist()
