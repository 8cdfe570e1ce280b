"""Connected components by large-star and small-star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import stored


def forest(edges: DataFrame) -> DataFrame:
    """Within each partition, edges replaced by one edge from each node to the smallest it reaches.

    Holds the nodes of one partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                union(parent, a, b)
        nodes = [node for node in parent if find(parent, node) != node]
        roots = [find(parent, node) for node in nodes]
        for start in range(0, len(nodes), 100_000):
            part = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[part], pa.int64()), pa.array(roots[part], pa.int64())], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def find(parent: dict[int, int], node: int) -> int:
    root = node
    while (above := parent.get(root, root)) != root:
        root = above
    while (above := parent.get(node, node)) != root:
        parent[node], node = root, above
    return root


def union(parent: dict[int, int], a: int, b: int) -> None:
    """The smaller root stays."""
    a, b = find(parent, a), find(parent, b)
    parent[max(a, b)] = parent[min(a, b)] = min(a, b)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``, bigint, no nulls).

    The component is its smallest node. Loops and repeated edges do no harm; no edges give no
    rows. Each round is written to the shared folder.
    """
    edges = stored(forest(edges), "edges")
    before = None
    while True:
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before or not after[0]:
            break
        before = after
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
