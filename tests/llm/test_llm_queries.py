"""Every registered query against SQL or a brute-force version, on the smallest tables."""

import glob
import hashlib
import html
import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from millrace.llm import decontaminate, queries
from millrace.llm.words import word_hashes

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def documents(db):
    return db.execute("SELECT doc_id, text, lang FROM documents ORDER BY doc_id").fetchall()


def rows(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, SF_DIR).collect()]


def test_all_are_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry_point.queries())
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, db, name):
    frame = queries.QUERIES[name](spark, SF_DIR)
    result = db.execute(queries.ORACLES[name])
    names = sorted(c[0] for c in result.description)
    assert sorted(frame.columns) == names
    places = [[c[0] for c in result.description].index(n) for n in names]
    want = sorted(repr([row[i] for i in places]) for row in result.fetchall())
    assert sorted(repr([r[n] for n in names]) for r in frame.collect()) == want


def leaks(documents, benchmark):
    """Documents and the items in them, by aligning every document with every item."""
    items = [(i, word_hashes(decontaminate.tokens(t))) for i, t in benchmark]
    found = set()
    for doc_id, text in documents:
        words = word_hashes(decontaminate.tokens(text))
        for item_id, item in items:
            if len(np.intersect1d(words, item)) < len(item) // 2:
                continue
            matched, _, _ = decontaminate.align(words, item)
            needed = min(len(item), decontaminate.LONG_ITEM)
            if matched >= decontaminate.THRESHOLD * needed and matched >= min(len(item), decontaminate.LEAST_WORDS):
                found.add((doc_id, item_id))
    return found


def test_decontaminate(spark, db, documents):
    want = leaks([d[:2] for d in documents], db.execute("SELECT item_id, text FROM benchmark").fetchall())
    assert want and {(r["doc_id"], r["item_id"]) for r in rows(spark, "op2_decontaminate")} == want


def test_language(spark, documents):
    found = {r["doc_id"]: r for r in rows(spark, "op3_language")}
    assert set(found) == {d[0] for d in documents}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [(found[i]["lang_pred"], lang) for i, _, lang in documents if found[i]["held_out"]]
    assert np.mean([a == b for a, b in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_html(spark, db):
    found = {r["page_id"]: r for r in rows(spark, "op4_html_extract")}
    for page_id, url, page in db.execute("SELECT page_id, url, html FROM pages").fetchall():
        inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
        blocks = re.sub(r"</?(p|h1|br)\b[^>]*>", " ", inside)
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", "", blocks)).split())
        assert (found[page_id]["text"], found[page_id]["n_chars"], found[page_id]["url"]) == (want, len(want), url)


def check_packing(found, texts):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    want = set()
    for doc_id, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want.add((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found} == want
    assert len(found) == len(want)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0] + [n for _, n in places[:-1]]))
        assert sum(n for _, n in places) <= 4096
    assert len(sequences) <= -(-sum(r["length"] for r in found) // 4096) + 1


def test_packing(spark, documents):
    check_packing(rows(spark, "op5_packing"), [d[:2] for d in documents])


def test_chat(spark, db):
    found = {r["conv_id"]: r for r in rows(spark, "op6_chat")}
    turns = defaultdict(list)
    for conv_id, role, text in db.execute("SELECT conv_id, role, text FROM conversations ORDER BY conv_id, turn").fetchall():
        turns[conv_id].append((role, text or ""))
    turns[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(found) == set(turns)
    for conv_id, want in turns.items():
        learned = "".join(t for r, t in want if r == "assistant")
        r = found[conv_id]
        assert (r["n_turns"], r["loss_chars"]) == (len(want), len(learned))
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{t}\n" for a, t in want).encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


def groups(texts):
    """Smallest id reachable by similarity of at least 0.8, and sizes, pair by pair."""
    sets = {}
    for i, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        n = max(1, len(words) - 4)
        sets[i] = frozenset(tuple(words[k : k + 5]) for k in range(n)) if words else frozenset()
    root = {i: i for i in sets}

    def of(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and 4 * len(sets[x]) <= 5 * len(sets[y]) and 4 * len(sets[y]) <= 5 * len(sets[x]):
                both = len(sets[x] & sets[y])
                if both and 180 * both >= 80 * (len(sets[x]) + len(sets[y])):
                    a, b = of(x), of(y)
                    root[max(a, b)] = min(a, b)
    return {i: of(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def test_jaccard(spark, documents):
    roots, sizes = groups([d[:2] for d in documents])
    found = rows(spark, "op7_ngram_jaccard")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == {i: (sizes[i], roots[i]) for i in roots}


def test_toxicity(spark, db, documents):
    found = {r["doc_id"]: r for r in rows(spark, "op8_toxicity")}
    assert set(found) == {d[0] for d in documents}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found.values())


def test_pipeline(spark, db, documents):
    """Every stage against brute force on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact_dedup", "ngram_jaccard", "decontaminate", "packing"]

    def after(name, docs):
        return stages[name](spark, docs, SF_DIR).cache()

    texts = {i: t for i, t, _ in documents}
    kept = after("language", docs)
    assert kept.columns == columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert all(re.search(r"[^\W\d_]", texts[i]) for i in ids) and len(ids) >= 0.98 * len(texts)

    kept = after("exact_dedup", kept)
    lowered = defaultdict(list)
    for i in ids:
        lowered[texts[i].translate({c: c + 32 for c in range(65, 91)})].append(i)
    ids = {max(same) for same in lowered.values()}
    assert {r["doc_id"] for r in kept.collect()} == ids and kept.columns == columns

    kept = after("ngram_jaccard", kept)
    roots, _ = groups([(i, texts[i]) for i in ids])
    ids = {i for i in ids if roots[i] == i}
    assert {r["doc_id"] for r in kept.collect()} == ids and kept.columns == columns

    kept = after("decontaminate", kept)
    found = leaks([(i, texts[i]) for i in ids], db.execute("SELECT item_id, text FROM benchmark").fetchall())
    ids -= {i for i, _ in found}
    assert {r["doc_id"] for r in kept.collect()} == ids and kept.columns == columns

    check_packing([r.asDict() for r in after("packing", kept).collect()], [(i, texts[i]) for i in ids])
    whole = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in whole.collect()} == ids


def test_rest_stands_without_this_package():
    """What the entry point does when the folders are gone."""
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['millrace.llm'] = None\n"
        "import __spark_entry__ as e; assert 'edits_hourly' in e.queries() and 'pipeline' not in e.queries()"
    )
    here = os.path.dirname(os.path.abspath(entry_point.__file__))
    assert subprocess.run([sys.executable, "-c", code], cwd=here).returncode == 0
