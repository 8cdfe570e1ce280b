import hashlib
import os
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import alignment, queries

SF_DIR = "/root/testdata/sf0.001"
BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Whole:
    """Whole texts through both tokenizers, byte by byte."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTES)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        self.letters = letters()

    def tokens(self, text):
        first = self.a.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(self.letters[c] for c in t)) for i, t in zip(first.ids, first.tokens)]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return [], []
        return a, b


def brute_force(rows):
    whole, docs, counts = Whole(), [], Counter()
    for doc_id, text in rows:
        a, b = whole.tokens(text or "")
        a_of = [n for n, (_, data) in enumerate(a) for _ in data]
        b_of = [n for n, (_, data) in enumerate(b) for _ in data]
        links = sorted(set(zip(a_of, b_of)))
        groups, left, right = [], [], []
        for place, (x, y) in enumerate(zip(a_of, b_of)):
            last = place + 1 == len(a_of)
            a_ends, b_ends = last or a_of[place + 1] != x, last or b_of[place + 1] != y
            left += [str(a[x][0])] * a_ends
            right += [str(b[y][0])] * b_ends
            if a_ends and b_ends:
                groups.append(f"{','.join(left)}|{','.join(right)}")
                left, right = [], []
        pairs = [(a[x][0], b[y][0]) for x, y in links]
        counts.update(pairs)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        docs.append((doc_id, len(a), len(b), len(groups), pairs, sha))
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    return [
        (d, a, b, g, len(pairs), sum(counts[p] == highest[p[1]] for p in pairs), sum(counts[p] for p in pairs), sha)
        for d, a, b, g, pairs, sha in docs
    ], counts


ODD = [
    None,
    "",
    " ",
    "a ",
    "  a  b   ",
    "tab\tand\nline \n  more \r\n end\n",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "▁ under ▁score",
    "naïve ½ ﬁ 日本語 テスト 한국어 🙂🙂 é",
    "x\x00y \x1c z\x85 w v u　t ﻿",
    "don't we'll I'm 'sup 1234567 3.14 a_b __x__ ...!!!",
    "A" * 3000,
    "word" * 500 + " " + "-" * 400,
    "the the the the",
    "a\nb\n\nc.\n d,\n\te;f g! h\n",
    "x\x1c\ny \x85\nz\n\x1cw e\u0301, n\u0303. ²½, 1.5,000 a>b <p>c</p>",
    "it's 's 't don't' \"q\" (r) [s] {t} u|v|w $1 &&& abc&&& a_b, _x_.",
]


def result(frame):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def texts(n, seed=0):
    rng = random.Random(seed)
    letters = "abcdeilnorst  \n\t.,'é日-0123456789A_"
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(n)]


def test_equals_whole_texts(spark, documents, clash):
    rows = list(enumerate(ODD + texts(60))) + [(3, ODD[3]), (500, "the the the the"), (None, "a null id")]
    want, _ = brute_force(rows)
    assert result(alignment.align(clash(documents(rows)), BYTES, PIECES)) == sorted(want, key=repr)


def test_blocks_and_forgotten_pieces_do_not_matter(spark, documents, monkeypatch):
    rows = list(enumerate(texts(80, seed=1)))
    want, _ = brute_force(rows)
    blocks = alignment.blocks
    monkeypatch.setattr(alignment, "blocks", lambda *args: blocks(*args, docs_per_block=7))
    assert result(alignment.align(documents(rows), BYTES, PIECES)) == sorted(want, key=repr)
    tokenizer = alignment.PairTokenizer(BYTES, PIECES)
    monkeypatch.setattr(alignment, "CACHE_PIECES", 5)
    for text in ODD[2:]:
        again = [alignment._document(0, tokenizer.parts([text])[0])[0] for _ in range(2)]
        assert again[0] == again[1] and len(tokenizer.known) < 60


def test_pair_counts(spark, documents):
    rows = list(enumerate(texts(50, seed=2) + ["the the the"] * 40))
    _, counts = brute_force(rows)
    got = alignment.pair_counts(documents(rows), BYTES, PIECES).collect()
    assert {(r["a"], r["b"]): r["links"] for r in got} == counts
    documents_of = Counter()
    for row in rows:
        documents_of.update(brute_force([row])[1].keys())
    assert {(r["a"], r["b"]): r["documents"] for r in got} == documents_of


def test_no_documents(documents):
    assert alignment.align(documents([]), BYTES, PIECES).collect() == []
    assert result(alignment.align(documents([(1, None)]), BYTES, PIECES)) == [(1, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("docs", [1, 9, 300])
def test_planes_hold_what_went_in(docs):
    rng = np.random.default_rng(docs)
    links = [rng.integers(6, size=int(rng.integers(0, 60))).astype(np.uint64) ** 3 << np.uint64(32) | rng.integers(3, size=1).astype(np.uint64) for _ in range(docs)]
    links += [np.full(1000, 7, dtype=np.uint64)] * (docs // 4)
    pairs, postings = alignment.Postings.of(links)
    n, own = postings.counts()
    assert dict(zip(pairs.tolist(), n.tolist())) == Counter(np.concatenate(links).tolist())
    assert dict(zip(pairs.tolist(), own.tolist())) == Counter(p for part in links for p in set(part.tolist()))
    total, top = postings.scores(n, (n > 50).astype(np.int64))
    count = dict(zip(pairs.tolist(), n.tolist()))
    assert total.tolist() == [sum(count[p] for p in part.tolist()) for part in links]
    assert top.tolist() == [sum(count[p] > 50 for p in part.tolist()) for part in links]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")
def test_query_equals_whole_texts(spark):
    docs = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    want, _ = brute_force(list(zip(docs["doc_id"], docs["text"])))
    assert result(queries.op11_alignment(spark, SF_DIR)) == sorted(want, key=repr)
