"""WARC records and a Merkle fixity audit of their replicas.

Pages become WARC records, which are packed into segments: ordered runs of records with their
byte offsets. Every record is hashed, every ``FAN_OUT`` neighbouring hashes form a node over
their offset range, and so on up to one root per segment and one per replica. Two replicas are
compared from the roots down: equal nodes end the search, only the children of differing ones
are read, until the differing records are reached.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from millrace.llm.tables import stored

#: Records of a segment (a power of two), and children of a node.
SEGMENT_RECORDS = 512
FAN_OUT = 8

VERSION = "WARC/1.0"
#: Date of records whose source has none.
UNDATED = "1970-01-01T00:00:00Z"


def record(url: Column, payload: Column, identifier: Column) -> Column:
    """One WARC resource record as bytes. Nulls are an empty target and an empty payload."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(identifier.cast("string"), F.lit("none")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", ""),
        F.lit(f"\r\nWARC-Date: {UNDATED}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary"))


def segments(pages: DataFrame) -> DataFrame:
    """An archive: ``segment, place, page_id, record``, in the order of the scan.

    A segment holds up to ``SEGMENT_RECORDS`` neighbouring rows of one task, so that no key
    decides its size; repeated rows are separate records. It is written once, and order and
    segments are those of the written archive from then on.
    """
    number = F.monotonically_increasing_id()
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        record(F.col("url"), F.col("html"), F.col("page_id")).alias("record"),
        number.alias("number"),
    )
    split = rows.select(
        F.shiftright("number", SEGMENT_RECORDS.bit_length() - 1).alias("segment"),
        F.col("number").bitwiseAND(F.lit(SEGMENT_RECORDS - 1)).cast("int").alias("place"),
        "page_id",
        "record",
    )
    return stored(split, "warc")


def leaves(archive: DataFrame) -> DataFrame:
    """``segment, place, page_id, offset, length, hash`` of every record of an archive."""
    sized = archive.select(
        "segment", "place", "page_id", F.coalesce(F.octet_length("record"), F.lit(0)).cast("bigint").alias("length"), F.unhex(F.sha2("record", 256)).alias("hash")
    )
    before = Window.partitionBy("segment").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return sized.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0).cast("bigint")))


@dataclass
class Tree:
    """Nodes ``segment, level, node, start, stop, hash``; level 0 holds the records."""

    nodes: DataFrame
    levels: int

    def root(self) -> str | None:
        """One hash for the replica: of its segments' roots, folded in order of their numbers."""
        top = self.nodes.where(F.col("level") == self.levels - 1).select(F.col("segment").alias("node"), "hash")
        while True:
            n = top.count()
            if n <= 1:
                row = top.first()
                return None if row is None else row["hash"].hex()
            parent = F.shiftright("node", SEGMENT_RECORDS.bit_length() - 1)
            dense = top.select(parent.alias("node"), F.struct("node", "hash").alias("child"))
            top = dense.groupBy("node").agg(_joined("child", ("node",)).alias("hash"))


def _joined(child: str, places: tuple[str, ...]) -> Column:
    """Hash of the children in order: of each where it is, whether it is null, and its hash.

    A node has ``FAN_OUT`` children (a root's fold ``SEGMENT_RECORDS``) at most.
    """
    ordered = F.sort_array(F.collect_list(child))

    def written(c: Column) -> Column:
        place = F.concat_ws(":", *(c[name].cast("string") for name in places), F.when(c["hash"].isNull(), "null").otherwise("hash"), F.lit(""))
        return F.concat(place.cast("binary"), F.coalesce(c["hash"], F.lit(b"")))

    return F.unhex(F.sha2(F.aggregate(ordered, F.lit(b""), lambda total, c: F.concat(total, written(c))), 256))


def build(leaf_rows: DataFrame) -> Tree:
    """The tree over a replica's leaves. Levels are fixed by the size of a segment."""
    level = leaf_rows.select(
        "segment", F.lit(0).alias("level"), F.col("place").alias("node"),
        F.col("offset").alias("start"), (F.col("offset") + F.col("length")).alias("stop"), "hash",
    )
    nodes, depth, width = level, 1, SEGMENT_RECORDS
    while width > 1:
        width = -(-width // FAN_OUT)
        level = (
            level.select("segment", "level", F.floor(F.col("node") / FAN_OUT).cast("int").alias("parent"), "start", "stop", F.struct("node", "start", "stop", "hash").alias("child"))
            .groupBy("segment", "level", "parent")
            .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), _joined("child", ("node", "start", "stop")).alias("hash"))
            .select("segment", (F.col("level") + 1).alias("level"), F.col("parent").alias("node"), "start", "stop", "hash")
        )
        nodes = nodes.unionByName(level)
        depth += 1
    return Tree(stored(nodes, "merkle"), depth)


def differing(ours: Tree, theirs: Tree) -> DataFrame:
    """``segment, node, start, stop, ours, theirs``: the records in which two replicas differ.

    A record that only one replica has counts as different, with a null on the other side. One
    that has only moved, because a record before it has, is searched for but not different.
    Replicas with the same root are not searched at all.
    """
    if ours.levels != theirs.levels:
        raise ValueError("trees of different shapes can't be compared")
    spark = ours.nodes.sparkSession
    suspects = None
    if ours.root() == theirs.root():
        ours_top = ours.nodes.where("false")
        return _compare(ours_top, theirs.nodes.where("false")).drop("level")
    for level in reversed(range(ours.levels)):
        a, b = (tree.nodes.where(F.col("level") == level) for tree in (ours, theirs))
        if suspects is not None:
            inside = suspects.select("segment", F.col("node").alias("parent"))
            a, b = (
                side.withColumn("parent", F.floor(F.col("node") / FAN_OUT).cast("int"))
                .join(inside, ["segment", "parent"], "left_semi")
                .drop("parent")
                for side in (a, b)
            )
        suspects = _compare(a, b)
        if level:
            suspects = stored(suspects, f"suspects-{level}")
    return suspects.drop("level")


def _compare(a: DataFrame, b: DataFrame) -> DataFrame:
    left = a.withColumnRenamed("hash", "ours")
    right = b.select("segment", "level", "node", F.col("start").alias("s"), F.col("stop").alias("t"), F.col("hash").alias("theirs"))
    return (
        left.join(right, ["segment", "level", "node"], "full")
        .where(~F.col("ours").eqNullSafe(F.col("theirs")) | F.col("start").isNull() | F.col("s").isNull())
        .select("segment", "level", "node", F.coalesce("start", "s").alias("start"), F.coalesce("stop", "t").alias("stop"), "ours", "theirs")
    )


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Where two archives (``segment, place, page_id, record``) differ, record by record.

    ``segment, place, page_id, start, stop, ours, theirs`` (hashes in hex; null where a
    replica lacks the record or has a null there). Empty archives are equal to each other. A null
    record takes no bytes and has a null hash: it equals a null record in the same place, and
    differs from content there and from no record at all.
    """
    leaf_rows = stored(leaves(ours), "leaves"), stored(leaves(theirs), "leaves")
    found = differing(build(leaf_rows[0]), build(leaf_rows[1]))
    names = [rows.select("segment", F.col("place").alias("node"), F.col("page_id").alias(name)) for rows, name in zip(leaf_rows, ("p", "q"))]
    return (
        found.join(names[0], ["segment", "node"], "left")
        .join(names[1], ["segment", "node"], "left")
        .select(
            "segment",
            F.col("node").alias("place"),
            F.coalesce("p", "q").alias("page_id"),
            "start",
            "stop",
            F.lower(F.hex("ours")).alias("ours"),
            F.lower(F.hex("theirs")).alias("theirs"),
        )
    )


_LENGTH = re.compile(rb"^content-length:\s*(\d+)\s*$", re.I | re.M)
_HEADER = re.compile(rb"^([^:\r\n]+):[ \t]*([^\r\n]*)\r?$", re.M)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and payload of each record in the bytes of a WARC file."""
    position = 0
    while position < len(data):
        head_end = data.index(b"\r\n\r\n", position)
        head = data[position:head_end]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record begins at byte {position}")
        length = int(_LENGTH.search(head)[1])
        payload = data[head_end + 4 : head_end + 4 + length]
        position = head_end + 4 + length
        if len(payload) < length or data[position : position + 4] != b"\r\n\r\n":
            raise ValueError(f"the record before byte {position} is cut off")
        position += 4
        names = {k.decode().strip().lower(): v.decode("utf-8", "replace") for k, v in _HEADER.findall(head)}
        yield names, payload
