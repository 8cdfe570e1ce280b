import hashlib
import uuid

from millrace.llm import exact_dedup


def decisions(frame, **options):
    return {(r["doc_id"], r["text_sha256"][:6]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.deduplicate(frame, **options).collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()[:6]


def test_largest_id_stays_and_only_ascii_case_is_folded(documents):
    frame = documents([(1, "Ab É"), (2, "aB É"), (3, "ab é"), (4, None), (5, ""), (6, " ")])
    assert decisions(frame) == {
        (1, sha("ab É")): (2, 2, False), (2, sha("ab É")): (2, 2, True), (3, sha("ab é")): (3, 1, True),
        (4, sha("")): (5, 2, False), (5, sha("")): (5, 2, True), (6, sha(" ")): (6, 1, True),
    }


def test_of_repeated_rows_one_stays_and_null_ids_count_as_smallest(documents):
    frame = documents([(7, "x"), (7, "x"), (None, "x"), (None, "y")])
    rows = exact_dedup.deduplicate(frame).collect()
    assert sorted((r["doc_id"] or 0, r["kept"]) for r in rows) == [(0, False), (0, True), (7, False), (7, True)]
    assert sorted((r["doc_id"] or 0, r["text"]) for r in exact_dedup.keep_one(frame).collect()) == [(0, "y"), (7, "x")]


def test_index_outlives_a_batch(spark, documents):
    index = exact_dedup.DigestIndex(spark, f"t_{uuid.uuid4().hex}", buckets=4)
    assert decisions(documents([(5, "a"), (6, "b")]), index=index, batch="one")[(5, sha("a"))] == (5, 1, True)
    second = decisions(documents([(9, "A"), (10, "c"), (11, "c")]), index=index, batch="two")
    assert second == {(9, sha("a")): (5, 1, False), (10, sha("c")): (11, 2, False), (11, sha("c")): (11, 2, True)}
    assert index.rows().count() == 3
    index.ingest(index.rows().drop("batch"), "two")
    assert index.rows().count() == 3


def test_index_is_read_without_a_shuffle(spark, documents):
    index = exact_dedup.DigestIndex(spark, f"t_{uuid.uuid4().hex}", buckets=4)
    index.ingest(exact_dedup.groups_of(documents([(1, "a")]).selectExpr("doc_id", "sha2(text, 256) AS digest", "'r' AS row")), "one")
    groups = exact_dedup.groups_of(documents([(2, "b")]).selectExpr("doc_id", "sha2(text, 256) AS digest", "'r' AS row"))
    plan = index.unseen(groups)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "SelectedBucketsCount: 4 out of 4" in plan


def test_empty_long_and_clashing(spark, documents, clash):
    assert exact_dedup.deduplicate(documents([])).count() == 0
    assert exact_dedup.keep_one(documents([])).count() == 0
    long = "word " * 200_000
    frame = clash(documents([(1, long), (2, long.upper()), (3, "x")]))
    kept = exact_dedup.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3]
    assert exact_dedup.deduplicate(frame).count() == 3


def test_registered_path_deduplicates_by_the_anti_join(spark, documents, monkeypatch):
    """Every batch after the first meets an index that holds something; the catalog is left as it was."""
    seen = []
    unseen = exact_dedup.DigestIndex.unseen

    def watched(self, groups):
        new = unseen(self, groups)
        seen.append((self.rows().count(), groups.count(), new.count(), new._jdf.queryExecution().sparkPlan().toString()))
        return new

    monkeypatch.setattr(exact_dedup.DigestIndex, "unseen", watched)
    frame = documents([(i, f"t{i % 30}") for i in range(60)] + [(None, "t1"), (None, None)])
    before = {t.name for t in spark.catalog.listTables()}
    rows = exact_dedup.deduplicate(frame).collect()
    assert {t.name for t in spark.catalog.listTables()} == before
    assert [s[0] for s in seen][0] == 0 and seen[-1][0] > 0 and seen[-1][2] < seen[-1][1]
    assert all("SortMergeJoin" in s[3] and "LeftAnti" in s[3] and "SelectedBucketsCount" in s[3] for s in seen)
    assert all(r["kept"] == (r["doc_id"] is not None and r["doc_id"] >= 30 or r["text_sha256"][:6] == sha("")) for r in rows)
    assert {r["group_size"] for r in rows} == {1, 2, 3}


def test_many_repeated_rows(documents, clash):
    frame = clash(documents([(7, "x")] * 300 + [(8, "X"), (8, "y"), (None, "y"), (None, "z"), (None, "z")]))
    kept = exact_dedup.keep_one(frame)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "z"), (8, "X"), (8, "y")]
    assert kept.columns == frame.columns
