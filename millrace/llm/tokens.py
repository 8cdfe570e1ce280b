"""Token ids of whole texts, fast because most words repeat."""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

#: Words whose ids a worker remembers; beyond that it starts anew.
CACHE_WORDS = 350_000

#: White space to ``str.split`` but not to the tokenizer.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPACES = re.compile(r"[ \n\t\r]+")
#: Words whose letters normalisation leaves alone but for their case, and whose digits are decimal.
_PLAIN = re.compile(r"[!-~¡-±´-¸º»¿-įı-ſ]+")
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: The settings under which a word's parts may be looked up one by one.
_EXPECTED_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of a tokenizer that drops white space before it splits words.

    The ids of a text are then those of its words, one after another. Words in plain letters
    are split into their parts here and only parts not met before go to the model; any other
    word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            pre = json.load(file)["pre_tokenizer"]["pretokenizers"][0]
        self.split = pre["pattern"]["Regex"] == _EXPECTED_SPLIT
        self.letters = _byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text, without special tokens."""
        if len(self.known) + len(self.parts) > CACHE_WORDS:
            self.known, self.parts = {"": b""}, {}
        known = self.known
        result = []
        for text in texts:
            words = _words(text)
            for word in words:
                if word not in known:
                    known[word] = self._word(word)
            result.append(np.frombuffer(b"".join([known[word] for word in words]), dtype="<u4"))
        return result

    def _word(self, word: str) -> bytes:
        plain = word.isascii() and word.isprintable() or _PLAIN.fullmatch(word) is not None
        if not (self.split and plain) or "<|" in word:
            return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        word = word.lower()
        parts = [word] if word.isalpha() else _PARTS.findall(word)
        return b"".join([self.parts.get(part) or self._part(part) for part in parts])

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        self.parts[part] = ids = _packed([token.id for token in self.tokenizer.model.tokenize(letters)])
        return ids


def _words(text: str) -> list[str]:
    """The words of a text; of a Latin-1 text without control strings in lower case."""
    if _SEPARATORS.search(text):
        return _SPACES.split(text)
    if "<|" not in text:
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    return text.split()


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per worker process, so that its memory of words outlives a task."""
    return WordTokenizer(path)
