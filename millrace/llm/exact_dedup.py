"""Exact deduplication against a persistent index of digests.

The index is a table bucketed and sorted by digest. New rows are summed up per digest,
compared with the index by a sort-merge anti-join that reads the index without a shuffle, and
what is new is appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.tables import ascii_lower, keyed, stored
from millrace.session import work_dir

BUCKETS = 64


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z in lower case; null counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


class DigestIndex:
    """A table ``(digest, keep_id, keep_row, group_size, batch)``, one row per digest and batch."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS, path: str | None = None):
        self.spark, self.name, self.buckets, self.path = spark, name, buckets, path

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        # One task per bucket, so that a batch adds one sorted file to each.
        writer = (
            groups.repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
        )
        if self.path is not None:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest the index doesn't hold."""
        if not self.exists():
            return groups
        known = self.rows().select("digest").hint("merge")
        return groups.join(known, "digest", "left_anti")

    def ingest(self, groups: DataFrame, batch: str) -> None:
        """Append what is new of ``(digest, keep_id, keep_row, group_size)``.

        Running a batch again appends nothing.
        """
        self.append(self.unseen(groups).withColumn("batch", F.lit(batch)))


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per digest of ``(digest, doc_id, row)``: largest id, its row, and the size.

    Sums are formed before the shuffle, so a digest with a third of all rows is no hot key.
    """
    best = F.max(F.struct("doc_id", "row"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")).select(
        "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"
    )


#: Batches in which a table without an index of its own goes through one.
BATCHES = 2


def deduplicate(docs: DataFrame, index: DigestIndex | None = None, batch: str = "first") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the largest ``doc_id`` stays; a null id counts as smallest, and of rows that
    share the largest id exactly one stays. Texts an earlier batch of ``index`` brought stay
    with that batch: ``keep_id`` then names the earlier document and ``group_size`` counts the
    group as it was appended. Without ``index`` a new one takes the rows in ``BATCHES`` batches,
    the largest ids first, so that what a later batch repeats is known already; ``group_size``
    then counts all rows. Null texts count as empty. Other columns are not read.
    """
    rows = _digested(docs, batch)
    if index is not None:
        index.ingest(groups_of(rows), batch)
        return _judged(rows, index.rows().drop("batch"))
    return _judged(*_through_new_index(rows))


def _digested(docs: DataFrame, batch: str) -> DataFrame:
    return stored(
        docs.select(
            "doc_id",
            digest(F.col("text")).alias("digest"),
            F.xxhash64("text").alias("mark"),
            F.concat(F.spark_partition_id(), F.lit("-"), F.monotonically_increasing_id()).alias("row"),
        ).withColumn("row", F.concat(F.lit(batch + "-"), F.col("row"))),
        "digests",
    )


def _through_new_index(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows, and the groups of an index of this call that took them batch by batch.

    The index lies in the scratch folder; its name in the catalog is given back at once.
    """
    spark = rows.sparkSession
    path = work_dir(spark, "digest-index")
    index = DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}", path=path)
    index.append(groups_of(rows.limit(0)).withColumn("batch", F.lit("")))
    cuts = rows.agg(F.percentile_approx("doc_id", [1 - i / BATCHES for i in range(1, BATCHES)])).first()[0] or [0] * (BATCHES - 1)
    upper = None
    for number, cut in enumerate([*cuts, None]):
        part = rows if upper is None else rows.where(F.col("doc_id").isNull() | (F.col("doc_id") < upper))
        part = part if cut is None else part.where(F.col("doc_id") >= cut)
        index.ingest(groups_of(part), str(number))
        upper = cut
    sizes = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    groups = stored(index.rows().select("digest", "keep_id", "keep_row").join(sizes, "digest"), "digest-groups")
    spark.sql(f"DROP TABLE {index.name}")
    return rows, groups


def _judged(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        "mark",
    )


def keep_one(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The documents that stay, with all their columns; of repeated rows, one.

    Decisions are made on ids and digests; the texts take part in no more than the last join.
    """
    same_row = ["doc_id", F.col("mark").alias("__mark")]
    decided = stored(
        deduplicate(docs, index).groupBy(*same_row).agg(F.max("kept").alias("kept"), F.count("*").alias("copies")), "decisions"
    )
    gone = stored(decided.where("NOT kept").select("doc_id", "__mark"), "gone")
    repeated = stored(decided.where("kept AND copies > 1").select("doc_id", "__mark"), "repeated")
    marked = docs.withColumn("__mark", F.xxhash64("text"))
    staying = keyed(marked, gone, "left_anti")
    if repeated.isEmpty():
        return staying.drop("__mark")
    once = keyed(staying, repeated, "left_semi").dropDuplicates(["doc_id", "__mark"])
    return keyed(staying, repeated, "left_anti").unionByName(once).drop("__mark")
