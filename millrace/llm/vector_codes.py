"""Compressing vectors to short codes: one learned codebook per part of the vector.

Vectors become whole numbers and are cut into equal consecutive parts; each part position has a
codebook that k-means refines. Every task builds anchors-hierarchy trees over stretches of its
vectors once (:mod:`millrace.llm.metric_tree`) and writes them to the shared folder; each round
walks the trees, so that whole balls are added up without a look at their points. Only sums per
part, entry and component are shuffled, and only codebooks reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm import metric_tree
from millrace.llm.tables import prepare, stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Vectors of one set of trees.
STRETCH = 4096
#: Larger components count as this: their sums over any table still have 38 digits.
CLAMP = 1e27

_LARGEST_ERROR = 2**63 - 1


@dataclass(frozen=True)
class Codebooks:
    """``entries[part][entry]`` is a list of whole numbers; ``width`` components per part."""

    entries: list[list[list[int]]]
    width: int

    def arrays(self) -> list[np.ndarray]:
        return [_numbers(np.array(part, dtype=object).reshape(len(part), self.width)) for part in self.entries]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position."""
        text = ",".join(str(x) for part in self.entries for entry in part for x in entry)
        return hashlib.sha256(text.encode()).hexdigest()


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, label, code, error, label_error, codebooks_sha256`` of every kept vector.

    ``vectors`` has ``vec_id``, ``embedding`` (array<float> or array<double>) and ``label``;
    other columns are not read. Rows whose vector is null or holds null, NaN or an infinity are
    dropped. Repeated rows count and are returned as often as they are there. The codebooks start
    from the smallest ids, null ids last, equal ids in the order of their vectors; with fewer
    vectors than entries there are as many entries as vectors. Vectors of different lengths are
    filled with zeros to the longest, whose length is rounded up to a multiple of ``parts``. An
    empty table gives an empty result. Components beyond ``CLAMP`` count as ``CLAMP``; an error
    beyond 64 bits is null, and so is its label's sum. Null labels are one label.
    """
    spark = vectors.sparkSession
    prepare(spark)
    kept = vectors.select("vec_id", "embedding", "label").where(finite(F.col("embedding")))
    longest = kept.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    width = -(-longest // parts)
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    forest = stored(_trees(kept, parts, width), "vector-trees")
    start = _whole([row["embedding"] for row in first], parts * width)
    books = Codebooks(
        [start[:, p * width : (p + 1) * width].tolist() for p in range(parts)] if len(first) else [[] for _ in range(parts)],
        width,
    )
    for _ in range(rounds):
        books = _refined(forest, books)
    coded = stored(_codes(forest, books, vectors.schema), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    whole = F.when(F.count_if(F.col("error").isNull()) == 0, total)
    by_label = stored(coded.groupBy("label").agg(whole.alias("label_error")), "label-errors").withColumnRenamed("label", "same_label")
    return (
        coded.join(by_label, F.col("label").eqNullSafe(F.col("same_label")), "left")
        .select("vec_id", "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
    )


def finite(vector: Column) -> Column:
    """True if the array and all its components are there and finite, else false."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(usable, F.lit(False))


def _whole(vectors: list, length: int) -> np.ndarray:
    """floor(SCALE * x) of all components; Python integers where 64 bits might not do."""
    table = np.zeros((len(vectors), length))
    for row, vector in zip(table, vectors):
        row[: len(vector)] = vector
    table = np.floor(table * SCALE)
    if np.abs(table).max(initial=0) < metric_tree.LARGEST:
        return table.astype(np.int64)
    return np.array([[int(max(-CLAMP, min(CLAMP, x))) for x in row] for row in table.tolist()], dtype=object).reshape(table.shape)


def _numbers(table: np.ndarray) -> np.ndarray:
    """As 64-bit integers where their squared distances fit, else as they are."""
    if all(abs(x) < metric_tree.LARGEST for x in table.flat):
        return table.astype(np.int64)
    return table


def _packed(table: np.ndarray) -> bytes:
    if table.dtype == object:
        return b"," + ",".join(map(str, table.flat)).encode()
    return b"=" + table.astype("<i4").tobytes()


def _unpacked(data: bytes, length: int) -> np.ndarray:
    if data[:1] == b",":
        numbers = [int(x) for x in data[1:].decode().split(",")]
        return np.array(numbers, dtype=object).reshape(-1, length)
    return np.frombuffer(data, dtype="<i4", offset=1).astype(np.int64).reshape(-1, length)


_TREES = "rows bigint, points binary, trees array<struct<order: binary, nodes: binary>>"


def _trees(kept: DataFrame, parts: int, width: int) -> DataFrame:
    """One row per stretch of vectors: ids, labels, points, and a tree for every part.

    Stretches with components too large for 64-bit distances have no trees; they are compared
    point by point.
    """
    id_type, label_type = kept.schema["vec_id"].dataType, kept.schema["label"].dataType
    schema = pa.schema(
        [
            ("vec_ids", pa.list_(to_arrow_type(id_type))),
            ("labels", pa.list_(to_arrow_type(label_type))),
            ("rows", pa.int64()),
            ("points", pa.binary()),
            ("trees", pa.list_(pa.struct([("order", pa.binary()), ("nodes", pa.binary())]))),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(3)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = rows(batches)
        while stretch := list(islice(source, STRETCH)):
            ids, vectors, labels = zip(*stretch)
            points = _whole(vectors, parts * width)
            trees = []
            if points.dtype != object and width:
                for part in range(parts):
                    tree = metric_tree.build(points[:, part * width : (part + 1) * width])
                    trees.append({"order": tree.order.astype("<i4").tobytes(), "nodes": tree.nodes.tobytes()})
            row = {"vec_ids": list(ids), "labels": list(labels), "rows": len(ids), "points": _packed(points), "trees": trees}
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    ddl = f"vec_ids array<{id_type.simpleString()}>, labels array<{label_type.simpleString()}>, {_TREES}"
    return kept.mapInArrow(run, ddl)


def _stretch(row: dict, books: list[np.ndarray], width: int) -> Iterator[tuple[int, np.ndarray, metric_tree.Tree | None, np.ndarray]]:
    """``(part, points, tree or None, entries)`` of every part of one stored stretch."""
    parts = len(books)
    points = _unpacked(row["points"], parts * width)
    for part, entries in enumerate(books):
        own = points[:, part * width : (part + 1) * width]
        if row["trees"] and entries.dtype != object:
            packed = row["trees"][part]
            order = np.frombuffer(packed["order"], dtype="<i4").astype(np.int64)
            nodes = np.frombuffer(packed["nodes"], dtype=metric_tree.node_type(width))
            yield part, own, metric_tree.Tree(order, nodes), entries
        else:
            yield part, own.astype(object), None, entries.astype(object)


def _one_by_one(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    if not len(entries):
        return np.zeros(len(points), dtype=np.int64)
    squares = np.array([[sum((x - y) ** 2 for x, y in zip(p, e)) for e in entries] for p in points], dtype=object)
    return np.array([min(range(len(row)), key=row.__getitem__) for row in squares], dtype=np.int64)


def _refined(forest: DataFrame, books: Codebooks) -> Codebooks:
    """Every entry replaced by the floor of the mean of its parts; unused entries stay."""
    arrays, width = books.arrays(), books.width
    if not width:
        return books
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(entries.shape, dtype=object) for entries in arrays]
        counts = [np.zeros(len(entries), dtype=np.int64) for entries in arrays]
        for batch in batches:
            for row in batch.to_pylist():
                for part, points, tree, entries in _stretch(row, arrays, width):
                    if tree is not None:
                        total, count = metric_tree.summed(tree, points, entries)
                        sums[part] += total.astype(object)
                        counts[part] += count
                        continue
                    for point, entry in zip(points, _one_by_one(points, entries)):
                        sums[part][entry] += point
                        counts[part][entry] += 1
        rows = [
            {"part": part, "entry": entry, "place": place, "total": str(sums[part][entry][place]), "n": int(counts[part][entry])}
            for part in range(len(arrays))
            for entry in range(len(arrays[part]))
            if counts[part][entry]
            for place in range(width)
        ]
        yield pa.RecordBatch.from_pylist(rows, schema=schema)

    partial = forest.select("points", "trees").mapInArrow(run, "part int, entry int, place int, total string, n bigint")
    # As many rows as the codebooks have components.
    totals = partial.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total"), F.sum("n").alias("n")
    )
    refined = [[list(entry) for entry in part] for part in books.entries]
    for row in totals.collect():
        refined[row["part"]][row["entry"]][row["place"]] = int(row["total"]) // row["n"]
    return Codebooks(refined, width)


def _codes(forest: DataFrame, books: Codebooks, given) -> DataFrame:
    """The code and the squared error of every vector."""
    arrays, width = books.arrays(), books.width
    id_type, label_type = given["vec_id"].dataType, given["label"].dataType
    schema = pa.schema([("vec_id", to_arrow_type(id_type)), ("label", to_arrow_type(label_type)), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["rows"]
                codes = np.zeros((n, len(arrays)), dtype=np.uint8)
                errors = np.zeros(n, dtype=object)
                if width:
                    for part, points, tree, entries in _stretch(row, arrays, width):
                        own = _one_by_one(points, entries) if tree is None else metric_tree.assigned(tree, points, entries)
                        codes[:, part] = own
                        errors += ((points - entries[own]) ** 2).sum(axis=1).astype(object)
                digits = codes.tobytes().hex()
                step = 2 * len(arrays)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["vec_ids"], schema.field("vec_id").type),
                        pa.array(row["labels"], schema.field("label").type),
                        pa.array([digits[i * step : (i + 1) * step] for i in range(n)], pa.string()),
                        pa.array([int(e) if e <= _LARGEST_ERROR else None for e in errors], pa.int64()),
                    ],
                    schema=schema,
                )

    ddl = f"vec_id {id_type.simpleString()}, label {label_type.simpleString()}, code string, error bigint"
    return forest.mapInArrow(run, ddl)
