import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from millrace.llm import decontaminate as D

RNG = random.Random(11)
VOCABULARY = ["w" + "".join(RNG.choices("abcdefgh", k=4)) for _ in range(3000)]


def prose(n, seed):
    return random.Random(seed).choices(VOCABULARY, k=n)


def brute(passage, item):
    """Smith-Waterman, cell by cell."""
    table = [[0] * (len(passage) + 1) for _ in range(len(item) + 1)]
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            same = D.MATCH if item[i - 1] == passage[j - 1] else D.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + same, table[i - 1][j] + D.GAP, table[i][j - 1] + D.GAP)
    return max(map(max, table))


@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12))
def test_alignment_is_smith_watermans(passage, item):
    matched, first, last = D.align(np.array(passage, dtype=np.uint64), np.array(item, dtype=np.uint64))
    best = brute(passage, item)
    assert (matched > 0) == (best > 0)
    assert 0 <= first <= last <= len(passage)
    if best:
        assert brute(passage[first:last], item) == best
        assert matched * D.MATCH >= best


def edited(words, every, rng):
    """A copy in which every so-manieth word is replaced, dropped or followed by another."""
    out = []
    for i, w in enumerate(words):
        if i % every == every - 1:
            kind = rng.choice(["replace", "drop", "insert"])
            out += {"replace": ["changed"], "drop": [], "insert": [w, "added"]}[kind]
        else:
            out.append(w)
    return out


def tables(spark, extra=()):
    items = [(i, " ".join(prose(35, 1000 + i)).capitalize() + ".") for i in range(12)]
    rows, want = [], set()
    for i in range(60):
        words, rng = prose(300, i), random.Random(i)
        if i < 12:
            words[100:100] = D.tokens(items[i][1])
            want.add((i, i))
        elif i < 24:
            words[40:40] = edited(D.tokens(items[i - 12][1]), 6, rng)
            want.add((i, i - 12))
        elif i < 30:
            words[40:40] = D.tokens(items[i - 24][1])[:12]
        rows.append((i, ", ".join(words)))
    benchmark = spark.createDataFrame([*items, *extra], "item_id bigint, text string")
    return rows, benchmark, want


def test_exact_and_edited_copies_are_found_and_nothing_else(spark, documents, clash):
    rows, benchmark, want = tables(spark, [(90, None), (91, ""), (92, "Only three words"), (None, rows_text(1000))])
    rows += [(60, None), (61, ""), (62, "only three words"), (None, rows_text(1000)), (0, rows[0][1])]
    found = D.contaminated(clash(documents(rows)), clash(benchmark)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want | {(62, 92)}
    assert len(found) == len(want) + 1
    for r in found:
        if r["doc_id"] < 12:
            assert r["score"] == 1.0 and (r["first_word"], r["last_word"]) == (100, 135)
        else:
            assert r["score"] >= D.THRESHOLD


def rows_text(seed):
    return " ".join(prose(35, seed))


def test_an_item_that_a_third_of_the_documents_share_is_found_in_all(spark, documents):
    rows, benchmark, _ = tables(spark)
    hot = " ".join(prose(35, 1003))
    shared = [(100 + i, " ".join(prose(50, 500 + i)) + " " + hot + " " + " ".join(prose(50, 800 + i))) for i in range(60)]
    found = D.contaminated(documents(rows + shared), benchmark)
    assert {r["doc_id"] for r in found.where("item_id = 3").collect()} >= {i for i, _ in shared}


def test_long_documents_and_repeated_copies(spark, documents):
    _, benchmark, _ = tables(spark)
    copy = " ".join(prose(35, 1005))
    long = " ".join(prose(40_000, 5)) + " " + " ".join([copy] * 40)
    rows = D.contaminated(documents([(1, long)]), benchmark).collect()
    assert [(r["item_id"], r["score"]) for r in rows] == [(5, 1.0)]


def test_empty_tables_and_keep_clean(spark, documents):
    rows, benchmark, want = tables(spark)
    docs = documents([*rows, (None, "no id"), (99, None)])
    kept = D.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {d for d, _ in want} | {None, 99}
    assert D.contaminated(documents([]), benchmark).count() == 0
    assert D.contaminated(docs, benchmark.where("false")).count() == 0


def test_an_edited_copy_is_found_beside_verbatim_ones(spark, documents):
    items, rows, want = [], [], set()
    for k, length in enumerate(range(30, 41)):
        item = prose(length, 2000 + k)
        changed = ["changed" if i % 6 == 5 else w for i, w in enumerate(item)]
        items.append((k, " ".join(item)))
        for copy, doc in ((item, 2 * k), (changed, 2 * k + 1)):
            rows.append((doc, " ".join([*prose(60, 3000 + doc), *copy, *prose(60, 4000 + doc)])))
            want.add((doc, k))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.contaminated(documents(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert {r["doc_id"] for r in D.keep_clean(documents(rows), benchmark).collect()} == set()


def test_an_ordinary_phrase_of_a_short_item_is_no_leak(spark, documents):
    short, middle = prose(6, 5000), prose(12, 5001)
    around = prose(40, 5002), prose(40, 5003)
    copies = [short[:4], short, middle[:7], middle[:8], middle]
    rows = [(i, " ".join([*around[0], *copy, *around[1]])) for i, copy in enumerate(copies)]
    benchmark = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(middle))], "item_id bigint, text string")
    found = D.contaminated(documents(rows), benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(1, 1), (3, 2), (4, 2)}


PHRASE = "which of the following is true about"


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def words_of(rng, n):
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


def test_a_phrase_of_all_items_and_documents_makes_no_pairs(spark, documents):
    rng = random.Random(4)
    items = [(i, f"{PHRASE} {' '.join(words_of(rng, 12))}") for i in range(60)]
    rows = [(i, f"{' '.join(words_of(rng, 20))} {PHRASE} {' '.join(words_of(rng, 20))}") for i in range(200)]
    leaked = {1000 + i: i for i in (3, 7, 11)}
    rows += [(doc, f"{' '.join(words_of(rng, 9))} {items[i][1]} end") for doc, i in leaked.items()]
    benchmark = items_of(spark, items)
    single = D._items(benchmark)
    seed_side = D.seeds(D.item_grams(single)).persist()
    phrase = set(D.grams(PHRASE).tolist())
    assert phrase.isdisjoint(r["gram"] for r in seed_side.collect())
    corpus_side = D.occurrences(documents(rows), D._filter(seed_side))
    # The leaks, and a few where the word after the phrase is the same too; not 203 * 60.
    assert len(leaked) <= D.diagonals(seed_side, corpus_side).count() <= 10
    found = D.contaminated(documents(rows), benchmark).collect()
    assert {r["doc_id"]: r["item_id"] for r in found} == leaked


def test_items_repeated_more_often_than_rare_are_all_found(spark, documents):
    rng = random.Random(5)
    text = words_of(rng, 30)
    same = [(i, " ".join(text)) for i in range(40)]
    near = [(100 + i, " ".join([*text[:29], f"other{i}"])) for i in range(25)]
    shared = words_of(rng, 30)  # every n-gram of these is in more items than is rare
    crowd = [(200 + i, " ".join(shared)) for i in range(20)] + [(300 + i, " ".join([f"a{i % 2}", *shared])) for i in range(3)]
    rows = [(1, " ".join(words_of(rng, 50) + text)), (2, " ".join(shared)), (3, " ".join(words_of(rng, 60)))]
    found = {(r["doc_id"], r["item_id"]) for r in D.contaminated(documents(rows), items_of(spark, same + near + crowd)).collect()}
    assert found == {(1, i) for i, _ in same + near} | {(2, i) for i, _ in crowd}


def test_seeds_of_an_item_without_a_rare_one_are_its_rarest(spark):
    rows = [(i, p, g) for i in range(30) for p, g in enumerate([1, 2] + ([3] if i < 20 else []))]
    frame = spark.createDataFrame(rows + [(99, 0, 1), (99, 1, 7)], "item_id bigint, place int, gram bigint")
    chosen = {}
    for r in D.seeds(frame, rare=4).collect():
        chosen.setdefault(r["item_id"], set()).add(r["gram"])
    assert chosen == {i: {3} for i in range(20)} | {i: {2} for i in range(20, 30)} | {99: {7}}


def test_filter_grows_with_the_seeds(spark):
    small = spark.range(10).selectExpr("id AS item_id", "0 AS place", "xxhash64(id) AS gram")
    large = spark.range(20_000).selectExpr("id AS item_id", "0 AS place", "xxhash64(id) AS gram")
    assert len(D._filter(small)) * 8 == D.LEAST_BITS
    bits = np.frombuffer(D._filter(large), dtype=np.uint8)
    assert len(bits) * 8 == 1 << 21
    keys = np.array([r["gram"] for r in large.collect()]) & (len(bits) * 8 - 1)
    assert (bits[keys >> 3] >> (keys & 7).astype(np.uint8) & 1).all()
    assert int(np.bitwise_count(bits).sum()) == len(np.unique(keys))
    assert not any(D._filter(small.where("false")))
