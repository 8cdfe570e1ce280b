"""Words and word shingles as 64-bit hashes, in numpy."""

from __future__ import annotations

import re

import numpy as np
import xxhash

from millrace.llm.tables import UPPER

#: Everything but the ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans(UPPER, UPPER.lower())
_FACTOR = 0x9E3779B97F4A7C15
#: Distinct words whose hashes a worker remembers.
CACHE_WORDS = 100_000

_known: dict[str, int] = {}


def words(text: str) -> list[str]:
    """A-Z lowered, cut at ASCII white space only."""
    text = text.lower() if text.isascii() else text.translate(_LOWER)
    return WORD.findall(text)


def word_hashes(found: list[str]) -> np.ndarray:
    """A 64-bit hash of each word."""
    known = _known
    try:
        return np.array([known[w] for w in found], dtype=np.uint64)
    except KeyError:
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in found:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.array([known[w] for w in found], dtype=np.uint64)


def text_hashes(text: str) -> np.ndarray:
    """``word_hashes(words(text))`` straight from the text's bytes, without a memory of words.

    Bytes are lowered and cut in ASCII only, which is what :func:`words` does to characters.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, found)), dtype=">u8").astype(np.uint64)


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words; of all words together if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        size, n = len(hashes), min(1, len(hashes))
    value = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        value = mixed(value * np.uint64(_FACTOR) ^ hashes[k : k + n])
    return value


def mixed(value: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole word."""
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return value ^ (value >> np.uint64(32))
