import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import packing
from millrace.llm.queries import TOKENIZER
from millrace.llm.tokens import WordTokenizer


@given(st.lists(st.integers(1, 30), max_size=12), st.integers(1, 60))
def test_fullest_is_the_best_subset(lengths, room):
    sums = {0}
    for length in lengths:
        sums |= {s + length for s in sums}
    chosen = packing.fullest(lengths, room)
    assert len(set(chosen)) == len(chosen)
    assert sum(lengths[i] for i in chosen) == max(s for s in sums if s <= room)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_every_piece_has_its_own_place(lengths):
    lengths = np.array(lengths, dtype=np.int64)
    numbers, offsets = packing.pack(lengths, 50)
    taken = {(n, o + k) for n, o, length in zip(numbers, offsets, lengths) for k in range(length)}
    assert len(taken) == lengths.sum()
    for n in set(numbers):
        assert {p for m, p in taken if m == n} == set(range(lengths[numbers == n].sum()))
        assert lengths[numbers == n].sum() <= 50


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def test_ids_are_the_tokenizers(tokenizer):
    texts = [
        "", "  ", "It's 12 O'CLOCK,\tisn't\x0b it?\x85\xa0x", "a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>",
        "É é ǆ İ ΑΣ Σ ſ ﬁ ½ x² ª", "日本 語 👍🏽‍ ​z", "a\x1cb \x1d", "".join(map(chr, range(1, 0x250))),
        " ".join(map(chr, range(1, 0x3000))), "word " * 50_000, "J̌ ǰ",
    ]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in WordTokenizer(TOKENIZER).encode(texts)] == want


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_ids_of_any_text(tokenizer, text):
    got = WordTokenizer.encode(_shared(), [text])[0].tolist()
    assert got == tokenizer.encode(text, add_special_tokens=False).ids


def _shared(cache=[]):
    if not cache:
        cache.append(WordTokenizer(TOKENIZER))
    return cache[0]


def test_pieces_and_places(documents, clash, tokenizer):
    texts = [(1, "a b c " * 3000), (2, None), (3, ""), (4, "x"), (4, "x"), (None, "null id"), (5, "word " * 4095), (6, "word " * 8191)]
    frame = clash(documents(texts))
    rows = packing.pack_pieces(packing.cut_pieces(frame, TOKENIZER)).collect()
    docs = {}
    for doc_id, text in texts:
        docs.setdefault(doc_id, []).append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    assert len(rows) == sum(math.ceil(len(ids) / 4096) for many in docs.values() for ids in many)
    for r in rows:
        part = docs[r["doc_id"]][0][r["start"] : r["start"] + r["length"]]
        assert r["start"] == r["piece"] * 4096 and len(part) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert places[0][0] == 0 and all(a[0] + a[1] == b[0] for a, b in zip(places, places[1:]))
        assert sum(places[-1]) <= 4096
    assert len(sequences) == math.ceil(sum(r["length"] for r in rows) / 4096)


def test_ids_on_request_and_empty_table(documents):
    assert packing.cut_pieces(documents([(1, "x")]), TOKENIZER, with_ids=True).first()["ids"][-1] == 1
    assert packing.pack_pieces(packing.cut_pieces(documents([]), TOKENIZER)).count() == 0
