"""Language identification: averaged hashed subword embeddings under a linear softmax.

The subwords are the runs of 3 and 4 bytes of the lower-cased text that don't reach across a
blank; each is hashed to a row of an embedding table, a text is the mean of its rows, and a
linear layer with softmax gives the languages. Training is stochastic gradient descent in
numpy on a bounded sample; a second part of the sample sets temperature and the score below
which an answer is rejected. Prediction reads whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import prepare

#: Labelled documents the model is fitted on, chosen by a hash of their ids.
SAMPLE = 3000
#: Bytes of a text that one training step reads; predictions read everything.
TRAINING_BYTES = 2000
BUCKETS = 1 << 15
DIMENSIONS = 16
EPOCHS = 3
RATE = 2.0
#: Share of the sample that calibrates, and the share of answers accepted there that may
#: disagree with their labels (labels have errors too); two may always.
CALIBRATION = 0.2
ACCEPTED_ERRORS = 0.02
#: Bytes that are hashed together.
CHUNK = 1 << 18

UNKNOWN = "und"

#: Bytes of ASCII that are no small letter count as blanks.
_BLANKED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_BLANKS = re.compile(rb" +")
_SIZES = (3, 4)


def buckets(text: str) -> np.ndarray:
    """How often each bucket occurs among the subwords of the whole text."""
    data = _BLANKS.sub(b" ", b" " + text.lower().encode("utf-8", "replace").translate(_BLANKED) + b" ")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    overlap = max(_SIZES) - 1
    for start in range(0, len(data), CHUNK):
        part = np.frombuffer(data[start : start + CHUNK + overlap], dtype=np.uint8)
        counts += np.bincount(_hashes(part, min(CHUNK, len(data) - start)), minlength=BUCKETS)
    return counts


def _hashes(data: np.ndarray, starts: int) -> np.ndarray:
    """Buckets of the subwords that begin at the first ``starts`` bytes."""
    blank = data == 32
    found = []
    value = data.astype(np.uint32)
    # A blank may begin or end a subword, not stand within it.
    inside = np.zeros(len(data), dtype=bool)
    for size in range(2, max(_SIZES) + 1):
        n = len(data) - size + 1
        if n <= 0:
            break
        value = value[:n] * np.uint32(0x01000193) ^ data[size - 1 :].astype(np.uint32)
        if size > 2:
            inside = inside[:n] | blank[size - 2 : size - 2 + n]
        else:
            inside = inside[:n]
        if size in _SIZES:
            whole = value[:starts][~inside[:starts]]
            mixed = (whole ^ np.uint32(size)) * np.uint32(0x9E3779B1)
            found.append(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1))
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint32)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # embeddings times weights: one row of language scores per bucket
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, counts: np.ndarray) -> np.ndarray:
        total = counts.sum()
        return (counts @ self.table) / max(total, 1) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score, and whether the answer is to be rejected."""
        if text is None or not any(c.isalpha() for c in text) or not self.languages:
            return UNKNOWN, 0.0, True
        scores = _softmax(self.logits(buckets(text)) / self.temperature)
        best = int(np.argmax(scores))
        score = min(1.0, float(scores[best]))
        return self.languages[best], score, score < self.threshold


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def fit(texts: list[str], labels: list[str], seed: int = 7) -> LanguageModel:
    """Train and calibrate on the given documents; none gives a model that knows no language."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    random = np.random.default_rng(seed)
    truth = np.array([languages.index(label) for label in labels])
    order = random.permutation(len(texts))
    held = order[: int(CALIBRATION * len(texts))] if len(texts) >= 10 else order[:0]
    fitted = np.array([i for i in order if i not in set(held.tolist())])

    def features(text: str) -> tuple[np.ndarray, np.ndarray]:
        counts = buckets(text)
        index = np.flatnonzero(counts)
        return index, counts[index] / max(counts.sum(), 1)

    sparse = {i: features(_excerpt(texts[i], random)) for i in fitted}
    embedding = random.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    weights = random.normal(0, 1 / DIMENSIONS, (DIMENSIONS, len(languages)))
    bias = np.zeros(len(languages))
    steps, step = EPOCHS * len(fitted), 0
    for _ in range(EPOCHS):
        for i in random.permutation(fitted):
            rate = RATE * (1 - step / steps)
            step += 1
            index, share = sparse[i]
            mean = share @ embedding[index]
            error = _softmax(mean @ weights + bias)
            error[truth[i]] -= 1
            back = weights @ error
            weights -= rate * 0.1 * np.outer(mean, error)
            bias -= rate * 0.01 * error
            embedding[index] -= rate * np.outer(share, back) * min(len(index), 100)
    model = LanguageModel(languages, embedding @ weights, bias, 1.0, 0.0)
    if len(held):
        _calibrate(model, [texts[i] for i in held], truth[held])
    return model


def _excerpt(text: str, random: np.random.Generator) -> str:
    start = int(random.integers(0, max(1, len(text) - TRAINING_BYTES)))
    return text[start : start + TRAINING_BYTES]


def _calibrate(model: LanguageModel, texts: list[str], truth: np.ndarray) -> None:
    """Temperature by likelihood; then the lowest score at which few accepted answers are wrong."""
    logits = np.array([model.logits(buckets(text)) for text in texts])
    choices = np.geomspace(0.25, 8, 24)
    picked = np.arange(len(truth))
    loss = [-np.log(np.maximum(_softmax(logits / t)[picked, truth], 1e-12)).mean() for t in choices]
    model.temperature = float(choices[int(np.argmin(loss))])
    scores = _softmax(logits / model.temperature)
    best, right = scores.max(axis=1), scores.argmax(axis=1) == truth
    order = np.argsort(-best)
    answers = 1 + np.arange(len(order))
    fine = np.flatnonzero(np.cumsum(~right[order]) <= np.maximum(2, ACCEPTED_ERRORS * answers))
    if fine[-1] == len(order) - 1:
        model.threshold = 1.0 / max(2, len(model.languages) - 1)
    else:
        model.threshold = float(best[order][fine[-1]])


def train(docs: DataFrame, allowed: Column, sample: int = SAMPLE) -> LanguageModel:
    """Fit on at most ``sample`` labelled documents among ``allowed``.

    They are those with the smallest hashes of their ids, whatever the order of the rows.
    """
    labelled = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rank = F.xxhash64("doc_id")
    last = labelled.select(rank.alias("rank")).orderBy("rank").limit(sample).agg(F.max("rank")).first()[0]
    if last is None:
        return fit([], [])
    rows = (
        labelled.where(rank <= last)
        .select(rank.alias("rank"), "text", "lang")
        .orderBy("rank", "text", "lang")
        .limit(sample)
        .collect()  # bounded by the sample
    )
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``rejected`` added.

    A null text, or one without a letter, is ``und`` with score 0 and rejected. Columns of
    these names that the input already has are replaced. Of the input only ``text`` is read.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            answers = [model.predict(text) for text in batch.column("text").to_pylist()]
            for name, kind, values in zip(
                ("lang_pred", "score", "rejected"),
                (pa.string(), pa.float64(), pa.bool_()),
                zip(*answers) if answers else ([], [], []),
            ):
                table = table.append_column(name, pa.array(values, kind))
            yield from table.to_batches()

    docs = docs.drop("lang_pred", "score", "rejected")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, ddl + ", lang_pred string, score double, rejected boolean")


def keep_known(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents whose language is not rejected, with all their columns as they are."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rejected = [model.predict(text)[2] for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
