"""Toxicity score: a weighted lexicon matched by an Aho-Corasick automaton.

Texts are folded first: lower case, accents of look-alike letters removed, digits and signs
within a word read as the letters they imitate. The lexicon holds whole words and word
beginnings with weights learned from a bounded labelled sample. Matches within an exception
phrase don't count. The sum of weights, normalised by the length of the text, is turned into a
probability by a logistic curve fitted on the same sample.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import prepare

#: Labelled documents of each class the lexicon is learned from, chosen by a hash of their ids.
SAMPLE_PER_CLASS = 1000
#: Shortest and longest word beginning that may become an entry, and shortest whole word.
STEMS = (4, 8)
#: An entry occurs in so many toxic documents that lack an explanation, at least, and in this
#: share of all toxic documents; a document is explained by so many entries.
MIN_SUPPORT = 3
MIN_SHARE = 0.02
EXPLAINED_BY = 3
#: Toxic documents with the entry, as a share of all documents with it (classes weighed equal).
MIN_PURITY = 0.9
MAX_ENTRIES = 400
PREDICT_AT = 0.3

# What characters are read as.
_LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "к": "k", "м": "m", "т": "t",
    "н": "h", "в": "b", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "υ": "u", "ν": "v",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "τ": "t", "ι": "i", "κ": "k", "χ": "x", "η": "n", "β": "b",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss",
}
_ACCENTED = {
    "a": "àáâãäåāăą", "c": "çćĉċč", "d": "ď", "e": "èéêëēĕėęě", "g": "ĝğġģ", "h": "ĥ", "i": "ìíîïĩīĭį",
    "j": "ĵ", "k": "ķ", "l": "ĺļľ", "n": "ñńņň", "o": "òóôõöōŏő", "r": "ŕŗř", "s": "śŝşš", "t": "ţť",
    "u": "ùúûüũūŭůűų", "w": "ŵ", "y": "ýÿŷ", "z": "źżž",
}
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
#: Phrases in which a lexicon word is harmless.
EXCEPTIONS = (
    "trash can", "trash bin", "trash collection", "clown fish", "circus clown", "clown car", "class clown",
    "pathetic fallacy", "sore loser rule", "loser bracket", "worthless check", "scum line", "pond scum",
)

_INVISIBLE = "​‌‍⁠﻿­"
_FULL_WIDTH = {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
_TABLE = str.maketrans(
    _LOOK_ALIKES
    | {letter: plain for plain, letters in _ACCENTED.items() for letter in letters}
    | _FULL_WIDTH
    | dict.fromkeys(_INVISIBLE, "")
)
_SIGNS = re.escape("".join(_DIGITS))
#: Signs between letters, or in front of one at the beginning of a word.
_IMITATED = re.compile(rf"(?<![^\W_])[{_SIGNS}]{{1,2}}(?=[a-z])|(?<=[a-z])[{_SIGNS}]{{1,2}}(?=[a-z])")
_TO_LETTERS = str.maketrans(_DIGITS)
_SUSPECT = re.compile(rf"[{_SIGNS}][a-z]")
_ONLY_LETTERS = bytes(b if 97 <= b <= 122 else 32 for b in range(256))


def fold(text: str) -> str:
    """The words of a text in plain small letters, each between single blanks."""
    folded = text.lower()
    if not folded.isascii():
        folded = folded.translate(_TABLE)
    if _SUSPECT.search(folded):
        folded = _IMITATED.sub(lambda m: m[0].translate(_TO_LETTERS), folded)
    words = folded.encode("ascii", "replace").translate(_ONLY_LETTERS).split()
    return f" {b' '.join(words).decode()} "


@dataclass
class ToxicityModel:
    """``entries``: " word " (whole) or " begin" (beginning) to weight."""

    entries: dict[str, float]
    slope: float
    intercept: float
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        machine = ahocorasick.Automaton()
        for entry, weight in self.entries.items():
            machine.add_word(entry, (entry, weight))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (f" {phrase} ", None))
        if len(machine):
            machine.make_automaton()
        return machine

    def signal(self, text: str | None, machine: ahocorasick.Automaton) -> float:
        """Summed weights of the matches, over one plus the logarithm of the word count."""
        if not text or not len(machine):
            return 0.0
        folded = fold(text)
        found, excused = [], []
        for end, (entry, weight) in machine.iter(folded):
            span = (end + 1 - len(entry), end + 1)
            if weight is None:
                excused.append(span)
            else:
                found.append((*span, weight))
        total = sum(w for a, b, w in found if not any(x <= a and b <= y for x, y in excused))
        return total / (1 + math.log1p(folded.count(" ")))

    def score(self, text: str | None, machine: ahocorasick.Automaton) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.signal(text, machine) + self.intercept))))


def _terms(folded: str) -> set[str]:
    shortest, longest = STEMS
    terms = set()
    for word in set(folded.split()):
        if len(word) >= shortest - 1:
            terms.add(f" {word} ")
            terms.update(f" {word[:n]}" for n in range(shortest, min(len(word), longest) + 1))
    return terms


def fit(toxic: list[str], clean: list[str]) -> ToxicityModel:
    """Learn lexicon and curve. Without toxic examples the model scores everything 0.5 or less."""
    if not toxic:
        return ToxicityModel({}, 0.0, -2.0)
    bad = [_terms(folded) for folded in _without_copies([fold(text) for text in toxic])]
    counted = Counter(term for terms in bad for term in terms)
    candidates = {term for term, n in counted.items() if n >= MIN_SUPPORT}
    harmless = Counter()
    for text in clean:
        harmless.update(_terms(fold(text)) & candidates)
    weights = {}
    for term in candidates:
        p = (counted[term] + 0.5) / (len(bad) + 1)
        q = (harmless[term] + 0.5) / (len(clean) + 1)
        if p / (p + q) >= MIN_PURITY:
            weights[term] = math.log(p / q)
    entries = _cover([terms & weights.keys() for terms in bad], weights)
    model = ToxicityModel(entries, 1.0, 0.0)
    machine = model.automaton()
    signals = np.array([model.signal(text, machine) for text in toxic + clean])
    truth = np.array([1.0] * len(toxic) + [0.0] * len(clean))
    model.slope, model.intercept = _logistic(signals, truth)
    return model


def _without_copies(folded: list[str]) -> list[str]:
    """One of texts that share one of two minimum hashes of their three-word shingles."""
    seen, kept = set(), []
    for text in folded:
        words = text.split()
        shingles = [" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2))]
        marks = {(seed, min(zlib.crc32(s, seed) for s in shingles)) for seed in (1, 2)}
        if not marks & seen:
            kept.append(text)
        seen |= marks
    return kept


def _cover(documents: list[set[str]], weights: dict[str, float]) -> dict[str, float]:
    """Entries chosen greedily, each for the toxic documents not yet explained by earlier ones.

    An entry whose documents are nearly those of a longer or shorter form adds nothing: forms of
    a chosen entry are passed over.
    """
    left = Counter(term for terms in documents for term in terms)
    holders: dict[str, list[int]] = {}
    for number, terms in enumerate(documents):
        for term in terms:
            holders.setdefault(term, []).append(number)
    explained = [0] * len(documents)
    entries: dict[str, float] = {}
    support = max(MIN_SUPPORT, int(MIN_SHARE * len(documents)))
    while left and len(entries) < MAX_ENTRIES:
        # Most documents first; then the heavier entry, then the longer.
        best = max(left, key=lambda t: (left[t] * weights[t], len(t), t))
        if left[best] < support:
            break
        entries[best] = weights[best]
        for number in holders[best]:
            explained[number] += 1
            if explained[number] == EXPLAINED_BY:
                left.subtract(documents[number])
        forms = best.strip()
        left = Counter(
            {
                term: n
                for term, n in left.items()
                if n >= support and not term.strip().startswith(forms) and not forms.startswith(term.strip())
            }
        )
    return entries


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept by Newton's method with a small penalty on the slope."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    weights = np.zeros(2)
    penalty = np.diag([ridge, 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        change = np.linalg.solve(hessian, gradient)
        weights -= change
        if np.abs(change).max() < 1e-8:
            break
    return float(weights[0]), float(weights[1])


def train(docs: DataFrame, labels: DataFrame, allowed: Column, per_class: int = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Fit on at most ``per_class`` documents of each class among ``allowed``.

    Those with the smallest hashes of their ids; rows without a label don't take part.
    """
    rank = F.xxhash64("doc_id")
    usable = labels.where(allowed & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    chosen = [
        usable.where(F.col("toxic") == value).withColumn("rank", rank).orderBy("rank", "doc_id").limit(per_class)
        for value in (0, 1)
    ]
    ids = chosen[0].unionByName(chosen[1]).drop("rank")  # 2 * per_class rows at most
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(
        F.first("text").alias("text")
    ).orderBy("doc_id").collect()
    texts = {value: [r["text"] or "" for r in rows if r["toxic"] == value] for value in (0, 1)}
    return fit(texts[1], texts[0])


def score(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``score`` (0 to 1) and ``predicted`` (0 or 1).

    A null or empty text has no match and gets the curve's lowest score. Repeated rows are each
    scored; ``text`` is read whole and is the only input.
    """
    prepare(docs.sparkSession)
    carried = docs.select("text", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.automaton()
        for batch in batches:
            scores = [model.score(text, machine) for text in batch.column("text").to_pylist()]
            table = pa.Table.from_batches([batch]).drop_columns("text")
            table = table.append_column("score", pa.array(scores, pa.float64()))
            table = table.append_column("predicted", pa.array([int(s >= PREDICT_AT) for s in scores], pa.int32()))
            yield from table.to_batches()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in carried.drop("text").schema)
    return carried.mapInArrow(run, ddl + ", score double, predicted int")
