import hashlib

import numpy as np
import pytest

from millrace.llm import metric_tree, vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, parts=8, entries=16, rounds=6):
    """Plain k-means over Python integers."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    width = -(-max(len(r[1]) for r in rows) // parts)
    whole = [[int(np.floor(4096 * float(np.float32(x)))) for x in r[1]] + [0] * (parts * width - len(r[1])) for r in rows]
    codes, errors, books = [[] for _ in rows], [0] * len(rows), []
    for part in range(parts):
        points = [v[part * width : (part + 1) * width] for v in whole]
        book = [list(p) for p in points[:entries]]

        def nearest(p):
            return min((sum((x - y) ** 2 for x, y in zip(p, e)), i) for i, e in enumerate(book))

        for _ in range(rounds):
            owners = [nearest(p)[1] for p in points]
            for i in range(len(book)):
                own = [p for p, o in zip(points, owners) if o == i]
                if own:
                    book[i] = [sum(xs) // len(own) for xs in zip(*own)]
        for n, p in enumerate(points):
            square, i = nearest(p)
            codes[n].append(i)
            errors[n] += square
        books.append(book)
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((r[0] is None, r[0] or 0, "".join(f"{i:02x}" for i in c), e, by_label[r[2]], sha) for r, c, e in zip(rows, codes, errors))


def encoded(spark, rows, schema=SCHEMA, change=lambda frame: frame):
    frame = change(spark.createDataFrame(rows, schema).repartition(3))
    return sorted(
        (r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
        for r in vector_codes.encode(frame).collect()
    )


def cloud(n, width=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, width))
    points = (centres[rng.integers(7, size=n)] + 0.1 * rng.normal(size=(n, width))).astype(np.float32)
    return [(i, points[i].tolist(), None if i % 5 == 0 else i % 3) for i in range(n)]


def test_equals_plain_k_means(spark):
    rows = cloud(300)
    assert encoded(spark, rows) == brute_force(rows)


def test_stretches_do_not_matter(spark, monkeypatch):
    rows = cloud(300)
    monkeypatch.setattr(vector_codes, "STRETCH", 20)
    assert encoded(spark, rows) == brute_force(rows)


def test_ties_repeats_nulls_and_lengths(spark, clash):
    rows = cloud(60, 9)
    rows += rows[:10] + [(None, rows[3][1], 1), (7, [0.5] * 9, None), (7, [0.25] * 9, None)]
    rows += [(100 + i, [0.125] * 9, 2) for i in range(90)]  # one very common vector
    rows += [(200, None, 1), (201, [1.0, None] + [0.0] * 7, 1), (202, [float("nan")] * 9, 1), (203, [float("inf")] * 9, 1)]
    rows += [(204, [], 1), (205, [0.5, -0.5], 1)]
    got = encoded(spark, rows, change=clash)
    assert got == brute_force(rows)
    assert len(got) == len(rows) - 4


def test_very_large_components(spark):
    """Compared in Python integers; what 64 bits can't hold is null, and so is its label's sum."""
    rows = cloud(40, 8) + [(1000, [1e20, -1e20, 3e19, 0, 0, 0, 0, 1.0], 9), (0, [2e7] * 8, 1)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    fits = lambda e: e if e < 2**63 else None
    want = [(*r[:3], fits(r[3]), fits(r[4]), r[5]) for r in brute_force(rows)]
    assert encoded(spark, rows) == want


def test_components_beyond_the_clamp(spark):
    rows = cloud(20, 8) + [(1000, [3e38, -3e38] + [0.0] * 6, 1)]
    assert len(encoded(spark, rows)) == 21


def test_few_and_no_vectors(spark):
    rows = cloud(5)
    assert encoded(spark, rows) == brute_force(rows)
    assert encoded(spark, []) == []
    empty = hashlib.sha256(b"").hexdigest()
    assert encoded(spark, [(1, [], 1), (2, [], None)]) == [(False, i, "00" * 8, 0, 0, empty) for i in (1, 2)]


def test_double_vectors(spark):
    rows = cloud(50, 8)
    got = encoded(spark, rows, SCHEMA.replace("float", "double"))
    assert got == brute_force(rows)


@pytest.mark.parametrize("spread", [0.0, 0.01, 10.0])
def test_tree_hands_over_what_points_would(spread):
    rng = np.random.default_rng(1)
    points = (rng.integers(-3, 3, size=(900, 6)) * 500 + spread * 50 * rng.normal(size=(900, 6))).astype(np.int64)
    entries = points[rng.integers(900, size=12)]
    entries[5] = entries[2]
    tree = metric_tree.build(points)
    nodes = tree.nodes
    assert sorted(tree.order.tolist()) == list(range(900))
    for node in nodes:
        own = points[tree.order[node["start"] : node["stop"]]]
        assert (own.sum(axis=0) == node["sum"]).all()
        assert np.sqrt(((own - node["centre"]) ** 2).sum(axis=1)).max() <= node["radius"] * (1 + 1e-9) + 1e-9
    want = ((points[:, None] - entries) ** 2).sum(axis=-1).argmin(axis=1)
    assert (metric_tree.assigned(tree, points, entries) == want).all()
    sums, counts = metric_tree.summed(tree, points, entries)
    assert (counts == np.bincount(want, minlength=12)).all()
    assert all((sums[e] == points[want == e].sum(axis=0)).all() for e in range(12))


def test_most_points_are_never_looked_at():
    rng = np.random.default_rng(2)
    centres = rng.integers(-10_000, 10_000, size=(16, 8))
    points = centres[rng.integers(16, size=4000)] + rng.integers(-100, 100, size=(4000, 8))
    tree = metric_tree.build(points)
    _, _, singles, _ = metric_tree.owned(tree, points, centres)
    assert len(singles) < 400
