import hashlib

from pyspark.sql import functions as F

from millrace.llm import warc


def archive(spark, rows, parts=3):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(parts)
    return warc.segments(pages)


def pages(n):
    return [(i, f"http://h/{i}", f"<p>{i} é</p>") for i in range(n)]


def test_records_parse_back(spark, clash):
    rows = [*pages(20), (None, None, None), (5, "http://h/5", ""), (6, "a\r\nb: c", "x" * 500_000), (6, "a\r\nb: c", "x" * 500_000)]
    frame = clash(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    stored = warc.segments(frame).orderBy("segment", "place").collect()
    assert len(stored) == len(rows)
    found = [(h.get("warc-target-uri", ""), body.decode()) for h, body in warc.parse(b"".join(bytes(r["record"]) for r in stored))]
    assert sorted(found) == sorted(((u or "").replace("\r", "").replace("\n", ""), t or "") for _, u, t in rows)


def test_offsets_are_those_of_the_file(spark):
    made = archive(spark, pages(1300))
    leaves = warc.leaves(made).collect()
    for segment in {r["segment"] for r in leaves}:
        rows = {r["place"]: bytes(r["record"]) for r in made.where(F.col("segment") == segment).collect()}
        data = b"".join(rows[p] for p in sorted(rows))
        for leaf in (r for r in leaves if r["segment"] == segment):
            part = data[leaf["offset"] : leaf["offset"] + leaf["length"]]
            assert hashlib.sha256(part).digest() == bytes(leaf["hash"])


def test_tree_against_a_tree_built_here(spark):
    made = archive(spark, pages(700), parts=1)
    leaves = sorted(warc.leaves(made).collect(), key=lambda r: (r["segment"], r["place"]))
    tree = warc.build(warc.leaves(made))

    def fold(nodes, named):
        written = b"".join(":".join(map(str, [*n[:named], "hash", ""])).encode() + n[3] for n in nodes)
        return nodes[0][1], nodes[-1][2], hashlib.sha256(written).digest()

    roots = []
    for segment in sorted({r["segment"] for r in leaves}):
        level = [(r["place"], r["offset"], r["offset"] + r["length"], bytes(r["hash"])) for r in leaves if r["segment"] == segment]
        for _ in range(tree.levels - 1):
            parents = [level[i : i + warc.FAN_OUT] for i in range(0, len(level), warc.FAN_OUT)]
            level = [(i, *fold(nodes, 3)) for i, nodes in enumerate(parents)]
        assert len(level) == 1
        roots.append((segment, *level[0][1:]))
    assert len(roots) == 2
    assert tree.root() == fold(roots, 1)[2].hex()


def test_twins_lost_in_different_places_differ(spark):
    rows = [(1, "u", "a"), (2, "v", "x"), (2, "v", "x"), (3, "w", "b")]
    ours = archive(spark, rows, parts=1)
    places = [r["place"] for r in ours.where("page_id = 2").orderBy("place").collect()]
    left, right = (ours.where(F.col("place") != place) for place in places)
    found = warc.audit(left, right).collect()
    assert sorted((r["place"], r["ours"] is None, r["theirs"] is None) for r in found) == sorted(
        [(places[0], True, False), (places[1], False, True)]
    )


def test_null_records(spark):
    ours = archive(spark, pages(40), parts=1)
    null = lambda *ids: ours.withColumn("record", F.when(~F.col("page_id").isin(*ids), F.col("record")))
    assert {r["page_id"] for r in warc.audit(ours, null(3, 17)).collect()} == {3, 17}
    assert warc.audit(null(3), null(3)).count() == 0
    assert {r["page_id"] for r in warc.audit(null(3), null(3, 4)).collect()} == {4}
    [row] = warc.audit(null(3), ours.where("page_id <> 3")).collect()
    assert (row["page_id"], row["ours"], row["theirs"]) == (3, None, None)
    every = ours.withColumn("record", F.lit(None).cast("binary"))
    assert warc.audit(every, every).count() == 0 and warc.audit(ours, every).count() == 40


def test_audit_finds_exactly_the_differing_records(spark):
    ours = archive(spark, pages(2000))
    assert warc.audit(ours, ours).count() == 0
    theirs = ours.where("page_id <> 77").withColumn(
        "record", F.when(F.col("page_id").isin(3, 1500), F.overlay("record", F.lit(b"?"), 20)).otherwise(F.col("record"))
    )
    rows = {r["page_id"]: r for r in warc.audit(ours, theirs).collect()}
    assert set(rows) == {3, 77, 1500}
    assert rows[77]["theirs"] is None and rows[3]["ours"] != rows[3]["theirs"]
    leaf = warc.leaves(ours).where("page_id = 1500").first()
    assert (rows[1500]["start"], rows[1500]["stop"]) == (leaf["offset"], leaf["offset"] + leaf["length"])
    assert {r["page_id"] for r in warc.audit(theirs, ours).collect()} == {3, 77, 1500}


def test_only_mismatching_branches_are_read(spark):
    ours = archive(spark, pages(2000))
    theirs = ours.withColumn("record", F.when(F.col("page_id") == 9, F.lit(b"")).otherwise(F.col("record")))
    a, b = (warc.build(warc.leaves(side)) for side in (ours, theirs))
    assert a.root() != b.root()
    assert warc.differing(a, b).count() == 1
    assert warc.differing(a, a).count() == 0


def test_empty_replicas(spark):
    nothing = archive(spark, [])
    assert warc.audit(nothing, nothing).count() == 0
    assert warc.audit(nothing, archive(spark, pages(3))).count() == 3
