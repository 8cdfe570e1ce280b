"""Exact n-gram Jaccard self-join with set-relation skipping.

Documents are sets of word shingles. Equal sets form a class and are handled once. Each set
shows a part of its shingles, chosen by hash alone so that similar sets show the same part. A
set that shows more shingles of its own than a similar partner could lack is out. Of the sets
left, each is entered into the lists of its rarest shown shingles, so many that two similar
sets meet in a list; what is connected through lists is a cluster, and links never cross
clusters.

Entries of those lists carry the shingle's position in its set. The first shingle that two sets
share leaves at most as many common ones as either has from there on, so that blocks of a list
whose positions leave too few for one another are skipped.

Within a cluster overlaps are counted exactly over index lists. A list holds sets in order of
size, so that the block whose sizes can't match is skipped, and the counts of a set are derived
from those of a very similar set counted before: only the lists of the shingles in which the
two differ are read.

A large cluster is cut into blocks. Each block is counted by itself, together with a few
representatives of the whole cluster; what is then not connected with the cluster's main group
is compared with everything, and the main group no more with itself. So a group of near copies
moves once, however large it is.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import components as cc
from millrace.llm.tables import keyed, prepare, stored
from millrace.llm.words import mixed, shingle_hashes, text_hashes

SHINGLE = 5
#: Sets link when ``100 * intersection >= SIMILAR * union``.
SIMILAR = 80
#: Hashes below this share of their range are shown.
SHOWN = 0.35
#: Sets up to this size show everything.
SMALL = 64
#: Cells of the table that tells how common shingles are, to put them in order. Its size never
#: changes; with more shingles to a cell the order gets coarser and stays an order.
CELLS = 1 << 22
#: Shown shingles handled together, and shingles of a block of a cluster.
BUCKET_SHINGLES = 250_000
BLOCK_SHINGLES = 500_000
#: Bytes of a shown hash that are kept and moved. Shingles that fall together only lead to
#: clusters larger than need be; counting in clusters uses all eight.
HASH_BYTES = 6
#: Cluster members that are sent to every task, by their bytes; more are joined by digest.
BROADCAST_BYTES = 1 << 24
MEMBER_BYTES = 64
#: Sets of a cluster that every block of it is compared with, as far as they fit into a block.
REPRESENTATIVES = 16
#: Counted sets from which others may be derived.
KEPT_COUNTS = 64


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of the whole text."""
    return np.unique(shingle_hashes(text_hashes(text or ""), SHINGLE))


def lacking(n):
    """How many of its ``n`` shingles a set may lack in a similar partner."""
    return n * (100 - SIMILAR) // 100


# Ways of showing shingles. Two similar sets always share a way in which a shown shingle is
# common to both: sets up to SMALL and their possible partners show everything (ALL); sets
# beyond SMALL show the hashes below SHOWN (SAMPLE). If no common shingle of two sets is below
# SHOWN, both have few there, and such sets show everything among themselves too (FEW).
ALL, SAMPLE, FEW = 0, 1, 2


def ways(n: int, below: int) -> list[tuple[int, int]]:
    """The ways a set of ``n`` shingles, ``below`` of them below SHOWN, takes part: way and count."""
    taken = [(ALL, n)] if n * SIMILAR <= SMALL * 100 else []
    if n > SMALL:
        taken.append((SAMPLE, below))
        if below <= lacking(n):
            taken.append((FEW, n))
    return taken


def _short(hashes: np.ndarray) -> bytes:
    """The first ``HASH_BYTES`` bytes of each hash, packed."""
    shifted = (hashes >> np.uint64(64 - 8 * HASH_BYTES)).astype("<u8")
    return shifted.view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    """What :func:`_short` packed, in place, the other bytes zero."""
    full = np.zeros((len(packed) // HASH_BYTES, 8), dtype=np.uint8)
    full[:, 8 - HASH_BYTES :] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, HASH_BYTES)
    return full.view("<u8").reshape(-1).astype(np.uint64)


def describe(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, n, below, digest, class, shown`` of every row.

    The last two bits of ``class`` are free for the way of showing.
    """
    prepare(docs.sparkSession)
    limit = np.uint64(SHOWN * 2.0**64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, belows, digests, classes, parts = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_set(text)
                below = int(np.searchsorted(hashes, limit))
                longest = max([count for _, count in ways(len(hashes), below)])
                digest = xxhash.xxh3_128_digest(hashes.tobytes())
                sizes.append(len(hashes))
                belows.append(below)
                digests.append(digest)
                classes.append(int.from_bytes(digest[:8], "little", signed=True) & ~3)
                parts.append(_short(hashes[:longest]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    pa.array(sizes, pa.int32()),
                    pa.array(belows, pa.int32()),
                    pa.array(digests, pa.binary()),
                    pa.array(classes, pa.int64()),
                    pa.array(parts, pa.binary()),
                ],
                names=["doc_id", "mark", "n", "below", "digest", "class", "shown"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("mark"), "text").mapInArrow(
        run, "doc_id bigint, mark bigint, n int, below int, digest binary, class bigint, shown binary"
    )


_DEALT = pa.schema(
    [
        ("bucket", pa.int32()),
        ("shingles", pa.binary()),
        ("owners", pa.binary()),
        ("places", pa.binary()),
        ("keys", pa.binary()),
        ("sizes", pa.binary()),
        ("needs", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def _deal(described: DataFrame, buckets: int, levels: np.ndarray | None = None) -> DataFrame:
    """Shown shingles dealt by hash: ``bucket`` and packed arrays of shingles, keys and sizes.

    A key is a class and a way. With ``levels`` only the rarest are dealt, as many as it takes
    for two similar sets to have a common one among them, and with each its place in that order;
    a key then also has the number of shingles it shows, and of those a similar set must show
    too. Of equal sets in one batch only the first is dealt.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = {c: i for i, c in reversed(list(enumerate(batch.column("class").to_pylist())))}
            columns = [batch.column(name).to_pylist() for name in ("n", "below", "class", "shown")]
            keys, sizes, needs, shown, parts = [], [], [], [], []
            for i in sorted(first.values()):
                n, below, klass, packed = (column[i] for column in columns)
                part = _unpacked(packed)
                for way, count in ways(n, below):
                    spread = mixed(part[:count] ^ np.uint64(way))
                    common = max(1, count - lacking(n))
                    if levels is not None:
                        order = np.lexsort((spread, levels[_cell(spread)]))
                        spread = spread[order[: count - common + 1]]
                    keys.append(klass | way)
                    sizes.append(n)
                    needs.append(common)
                    shown.append(count)
                    parts.append(spread)
            of_key = {"keys": np.array(keys, dtype=np.int64)}
            of_key |= {name: np.array(values, dtype=np.int32) for name, values in (("sizes", sizes), ("needs", needs), ("counts", shown))}
            yield from _packed(parts, of_key, buckets, placed=levels is not None)

    return described.where("n > 0").select("n", "below", "class", "shown").mapInArrow(
        run,
        "bucket int, shingles binary, owners binary, places binary, keys binary, sizes binary, needs binary, counts binary",
    )


def _high(spread: np.ndarray, parts: int) -> np.ndarray:
    """Which of equal parts of the range a hash falls into."""
    return ((spread >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _cell(spread: np.ndarray) -> np.ndarray:
    return _high(spread, CELLS).astype(np.int64)


def _packed(parts: list[np.ndarray], of_key: dict[str, np.ndarray], buckets: int, placed: bool) -> Iterator[pa.RecordBatch]:
    lengths = [len(p) for p in parts]
    if not sum(lengths):
        return
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), lengths)
    place = np.concatenate([np.arange(n, dtype=np.uint32) for n in lengths])
    spread = np.concatenate(parts)
    bucket = _high(spread, buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, owner, place, spread = bucket[order], owner[order], place[order], spread[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rows = []
    for a, b in zip(starts, np.r_[starts[1:], len(bucket)]):
        held, local = np.unique(owner[a:b], return_inverse=True)
        rows.append(
            {
                "bucket": int(bucket[a]),
                "shingles": _short(spread[a:b]),
                "owners": local.astype(np.uint16).tobytes(),
                "places": place[a:b].tobytes() if placed else b"",
                "keys": of_key["keys"][held].tobytes(),
                "sizes": of_key["sizes"][held].tobytes(),
                "needs": of_key["needs"][held].tobytes() if placed else b"",
                "counts": of_key["counts"][held].tobytes() if placed else b"",
            }
        )
    yield pa.RecordBatch.from_pylist(rows, schema=_DEALT)


@dataclass(frozen=True)
class Lists:
    """The lists of a bucket: distinct pairs of shingle and owner, sorted.

    Owners point into ``keys``, ``sizes``, ``needs`` and ``counts``, which are in order of size.
    ``places``, ``needs`` and ``counts`` are empty where none were dealt.
    """

    shingles: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    keys: np.ndarray
    sizes: np.ndarray
    needs: np.ndarray
    counts: np.ndarray


def _lists(dealt: DataFrame, of_bucket: Callable[[Lists], list[pa.Array]], schema: pa.Schema, ddl: str) -> DataFrame:
    """``of_bucket`` for the lists of every bucket, one bucket at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != current and held:
                    yield pa.RecordBatch.from_arrays(of_bucket(_merged(held)), schema=schema)
                    held = []
                current = row["bucket"]
                held.append(row)
        if held:
            yield pa.RecordBatch.from_arrays(of_bucket(_merged(held)), schema=schema)

    return dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, ddl)


def _merged(rows: list[dict]) -> Lists:
    def joined(name: str, kind: type) -> np.ndarray:
        return np.concatenate([np.frombuffer(r[name], dtype=kind) for r in rows])

    keys, places = joined("keys", np.int64), joined("places", np.uint32)
    shingles = np.concatenate([_unpacked(r["shingles"]) for r in rows])
    shift = np.cumsum([0] + [len(r["keys"]) // 8 for r in rows])
    owners = np.concatenate([np.frombuffer(r["owners"], dtype=np.uint16).astype(np.int64) + s for r, s in zip(rows, shift)])
    distinct, at = np.unique(keys, return_index=True)
    sizes = joined("sizes", np.int32)[at]
    by_size = np.argsort(sizes, kind="stable")
    rank = np.empty(len(distinct), dtype=np.int64)
    rank[by_size] = np.arange(len(distinct))
    owners = rank[np.searchsorted(distinct, keys)][owners]
    # Of a repeated pair the first place stays.
    order = np.lexsort((places, owners, shingles) if len(places) else (owners, shingles))
    shingles, owners, places = shingles[order], owners[order], places[order] if len(places) else places
    fresh = np.r_[True, (shingles[1:] != shingles[:-1]) | (owners[1:] != owners[:-1])]
    needs, counts = (joined(name, np.int32) for name in ("needs", "counts"))
    if len(places):
        places, needs, counts = places[fresh], needs[at][by_size], counts[at][by_size]
    return Lists(shingles[fresh], owners[fresh], places, distinct[by_size], sizes[by_size], needs, counts)


_SHARED = pa.schema([("key", pa.list_(pa.int64())), ("shared", pa.list_(pa.int32())), ("first_cell", pa.int32()), ("levels", pa.binary())])


def _shared(of: Lists) -> list[pa.Array]:
    """How many of a key's shingles others have too; and how common shingles are, by cell."""
    shingles, owners, keys = of.shingles, of.owners, of.keys
    starts = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]])
    common = np.diff(np.r_[starts, len(shingles)])
    counts = np.bincount(owners[np.repeat(common > 1, common)], minlength=len(keys))
    found = np.flatnonzero(counts)
    cells = _cell(shingles[starts])
    levels = np.zeros(int(cells[-1] - cells[0]) + 1, dtype=np.uint8)
    np.maximum.at(levels, cells - cells[0], np.log2(common).astype(np.uint8))
    return [
        pa.array([keys[found].tolist()], pa.list_(pa.int64())),
        pa.array([counts[found].tolist()], pa.list_(pa.int32())),
        pa.array([int(cells[0])], pa.int32()),
        pa.array([levels.tobytes()], pa.binary()),
    ]


def _reachable(of: Lists) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of owners that connect those of a list whose sizes and positions can match.

    In order of size a list falls into blocks between which sizes can't match. In such a block an
    entry covers the range from the shingles its set needs to those it has left from its position
    on; two entries can match only if their ranges meet. In order of need, each entry is tied to
    the one before it that reaches furthest, or starts a new block.
    """
    sizes = of.sizes[of.owners].astype(np.int64)
    apart = np.r_[True, (of.shingles[1:] != of.shingles[:-1]) | (100 * sizes[:-1] < SIMILAR * sizes[1:])]
    block = np.cumsum(apart)
    need = of.needs[of.owners].astype(np.int64)
    order = np.lexsort((need, block))
    block, need, owners = block[order], need[order], of.owners[order]
    reach = (block << 32) + of.counts[owners] - of.places[order].astype(np.int64)
    furthest = np.maximum.accumulate(reach)
    holder = np.maximum.accumulate(np.where(np.r_[True, reach[1:] > furthest[:-1]], np.arange(len(reach)), 0))
    met = np.flatnonzero((block[1:] == block[:-1]) & (furthest[:-1] >= (block[1:] << 32) + need[1:])) + 1
    return owners[holder[met - 1]], owners[met]


def _chained(of: Lists) -> list[pa.Array]:
    """What the lists connect, as a forest."""
    if not len(of.owners):
        return [pa.array([], pa.int64()), pa.array([], pa.int64())]
    pairs = np.unique(np.stack(_reachable(of), axis=1), axis=0)
    parent: dict[int, int] = {}
    for a, b in pairs.tolist():
        cc.union(parent, a, b)
    nodes = [x for x in parent if cc.find(parent, x) != x]
    roots = [cc.find(parent, x) for x in nodes]
    classes = of.keys & ~3
    return [pa.array(classes[nodes], pa.int64()), pa.array(classes[roots], pa.int64())]


def clusters(described: DataFrame, classes: DataFrame) -> DataFrame:
    """``class, cluster`` of the classes that may have a link."""
    n, below = F.col("n"), F.col("below")
    most = F.floor(n * (100 - SIMILAR) / 100)
    way = lambda number, count, applies: F.when(applies, F.struct(F.lit(number).alias("way"), count.alias("counted")))
    taken = F.array_compact(
        F.array(way(ALL, n, n * SIMILAR <= SMALL * 100), way(SAMPLE, below, n > SMALL), way(FEW, n, (n > SMALL) & (below <= most)))
    )
    entered = classes.select("class", "n", F.explode(taken).alias("taken")).select(
        F.col("class").bitwiseOR(F.col("taken.way").cast("bigint")).alias("key"), "n", "taken.counted"
    )
    total = entered.agg(F.sum("counted")).first()[0] or 0
    buckets = int(total // BUCKET_SHINGLES) + 1
    counted = stored(_lists(_deal(described, buckets), _shared, _SHARED, "key array<bigint>, shared array<int>, first_cell int, levels binary"), "shared")
    levels = np.zeros(CELLS, dtype=np.uint8)
    for row in counted.select("first_cell", "levels").toLocalIterator():  # CELLS bytes in all
        found = np.frombuffer(row["levels"], dtype=np.uint8)
        part = levels[row["first_cell"] : row["first_cell"] + len(found)]
        np.maximum(part, found, out=part)
    shared = counted.select(F.explode(F.arrays_zip("key", "shared")).alias("pair")).groupBy("pair.key").agg(F.sum("pair.shared").alias("shared"))
    dense = stored(
        entered.join(shared, "key").where(F.col("counted") - F.col("shared") <= most).select(F.col("key").bitwiseAND(F.lit(~3)).alias("class")).distinct(),
        "dense",
    )
    left = keyed(described, dense, "left_semi")
    edges = _lists(_deal(left, buckets, levels), _chained, pa.schema([("a", pa.int64()), ("b", pa.int64())]), "a bigint, b bigint")
    return cc.components(edges.where("a <> b")).withColumnsRenamed({"node": "class", "component": "cluster"})


_LINKED = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])


def count_links(sets: list[np.ndarray], split: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """For each set the later ones it links with, or those from ``split`` on if it comes before it.

    Sets must not be empty. Yields positions in ``sets``; every unordered pair is met once.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    ranked = sizes[order]
    place = np.empty(m, dtype=np.int64)
    place[order] = np.arange(m)
    indexed = order if split is None else order[order >= split]
    owner = np.repeat(place[indexed], sizes[indexed])
    tokens, local = np.unique(np.concatenate([sets[i] for i in indexed]), return_inverse=True)
    by_token = np.lexsort((owner, local))
    lists = owner[by_token]
    bounds = np.searchsorted(local[by_token], np.arange(len(tokens) + 1))
    keys = local[by_token] * (m + 1) + lists
    kept: OrderedDict[int, np.ndarray] = OrderedDict()
    nearest: dict[int, tuple[int, int]] = {}
    within: dict[int, np.ndarray] = {}

    def ids(i: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(tokens, sets[i]), len(tokens) - 1)
        return at[tokens[at] == sets[i]]

    def counted(of: np.ndarray, low: int, high: int) -> np.ndarray:
        """Occurrences of sets in the lists, without the blocks before ``low`` and from ``high`` on."""
        starts = np.searchsorted(keys, of * (m + 1) + low)
        lengths = np.searchsorted(keys, of * (m + 1) + high) - starts
        total = int(lengths.sum())
        if not total:
            return np.zeros(high - low, dtype=np.int64)
        index = np.repeat(starts - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(total)
        return np.bincount(lists[index] - low, minlength=high - low)

    for position in range(m):
        i = int(order[position])
        if split is not None and i >= split:
            continue
        n = int(sizes[i])
        low = int(np.searchsorted(ranked, -(-n * SIMILAR // 100)))
        high = int(np.searchsorted(ranked, n * 100 // SIMILAR, side="right"))
        own = ids(i)
        counts = None
        if i in nearest and nearest[i][1] in kept:
            reference = nearest[i][1]
            a, b, base = kept[reference]
            other = within[reference]
            # Blocks both have counted; the reference covers this set's if sizes are equal.
            if a <= low and high <= b:
                gained = np.setdiff1d(own, other, assume_unique=True)
                lost = np.setdiff1d(other, own, assume_unique=True)
                weight = bounds[gained + 1].sum() - bounds[gained].sum() + bounds[lost + 1].sum() - bounds[lost].sum()
                if weight < bounds[own + 1].sum() - bounds[own].sum():
                    counts = base[low - a : high - a] + counted(gained, low, high) - counted(lost, low, high)
        if counts is None:
            counts = counted(own, low, high)
        others = ranked[low:high]
        linked = np.flatnonzero((100 + SIMILAR) * counts >= SIMILAR * (n + others)) + low
        for p in linked[linked > position] if split is None else ():
            j = int(order[p])
            overlap = int(counts[p - low])
            if nearest.get(j, (0, 0))[0] < overlap:
                nearest[j] = (overlap, i)
        kept[i] = (low, high, counts)
        within[i] = own
        if len(kept) > KEPT_COUNTS:
            gone, _ = kept.popitem(last=False)
            del within[gone]
        found = order[linked]
        yield i, found[place[found] > position] if split is None else found


def _verify(rows: list[dict]) -> list[dict]:
    """Links within one block of a cluster, or between two."""
    rows = list({row["node"]: row for row in rows}.values())
    first, second = rows[0]["first"], rows[0]["second"]
    split = None
    if first != second:
        rows.sort(key=lambda r: r["block"])
        split = sum(r["block"] == first for r in rows)
        if split in (0, len(rows)):
            return []
    if len(rows) < 2:
        return []
    sets = [np.frombuffer(r["shingles"], dtype=np.uint64) for r in rows]
    links = [0] * len(rows)
    parent: dict[int, int] = {}
    for i, found in count_links(sets, split):
        for j in found.tolist():
            links[i] += rows[j]["copies"]
            links[j] += rows[i]["copies"]
            cc.union(parent, rows[i]["node"], rows[j]["node"])
    return [
        {"node": row["node"], "root": cc.find(parent, row["node"]), "links": count}
        for row, count in zip(rows, links)
        if count
    ]


def _tasks(block: Column, low: Column, high: Column) -> Column:
    """The pairs of a block with each from ``low`` to ``high``, both included."""
    return F.transform(F.sequence(low, high), lambda o: F.struct(F.least(block, o).alias("first"), F.greatest(block, o).alias("second")))


def _blocks(total: Column) -> Column:
    return F.ceil(total / BLOCK_SHINGLES).cast("int")


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("node"), blocks).cast("int")


def placed(members: DataFrame) -> DataFrame:
    """``members`` of clusters of more than one class, with ``blocks`` of the cluster and their ``block``.

    ``members`` has ``node, digest, cluster, n, copies, doc_id`` (of one document each).
    """
    totals = members.groupBy("cluster").agg(F.sum("n").alias("total"), F.count("*").alias("size")).where("size > 1")
    return stored(
        members.join(totals.select("cluster", _blocks(F.col("total")).alias("blocks")), "cluster").withColumn(
            "block", _block(F.col("blocks"))
        ),
        "members",
    )


def _representatives(members: DataFrame) -> DataFrame:
    """``node`` of the classes of most copies of each cluster that has several blocks."""
    first = Window.partitionBy("cluster").orderBy(F.desc("copies"), "node")
    ranked = members.where("blocks > 1").select("cluster", "node", "n", "copies").withColumn("rank", F.row_number().over(first))
    few = ranked.where(F.col("rank") <= REPRESENTATIVES).withColumn("so_far", F.sum("n").over(first.rowsBetween(Window.unboundedPreceding, 0)))
    return few.where((F.col("rank") == 1) | (F.col("so_far") <= BLOCK_SHINGLES)).select("node")


def connected(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``node, component`` of linked classes of ``placed`` members, without comparing all of them.

    First every block is counted with the representatives. Members of the largest group found in a
    cluster need no more comparison among themselves; each other one is compared with all.
    """
    chosen = stored(_representatives(members).withColumn("chosen", F.lit(True)), "representatives")
    first = members.join(chosen, "node", "left")
    everywhere = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(o.alias("first"), o.alias("second")))
    tasks = F.when(F.col("chosen"), everywhere).otherwise(_tasks(F.col("block"), F.col("block"), F.col("block")))
    joined = stored(cc.components(_edges(stored(verified(docs, first, tasks), "links"))), "connected")

    grouped = stored(
        members.where("blocks > 1").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node")), "grouped"
    )
    sums = grouped.groupBy("cluster", "component").agg(F.sum("n").alias("total"))
    main = sums.groupBy("cluster").agg(
        F.max_by("component", F.struct("total", "component")).alias("main"), F.max("total").alias("ours"), F.sum("total").alias("total")
    )
    open_ = main.where("total > ours").select(
        "cluster", "main", _blocks(F.col("ours")).alias("ours"), _blocks(F.col("total") - F.col("ours")).alias("theirs")
    )
    is_main = F.col("component") == F.col("main")
    left = stored(
        grouped.drop("block", "blocks")
        .join(open_, "cluster")
        .withColumn("block", F.when(is_main, _block(F.col("ours"))).otherwise(F.col("ours") + _block(F.col("theirs"))))
        .withColumn("lowest", F.when(is_main, F.col("ours")).otherwise(F.lit(0))),
        "unconnected",
    )
    if left.isEmpty():
        return joined
    rest = verified(docs, left, _tasks(F.col("block"), F.col("lowest"), F.col("ours") + F.col("theirs") - 1))
    known = joined.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a <> b")
    return cc.components(known.unionByName(_edges(rest)))


def _edges(links: DataFrame) -> DataFrame:
    return links.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b")


def verified(docs: DataFrame, members: DataFrame, tasks: Column) -> DataFrame:
    """``node, root, links`` of linked classes, pair by pair of blocks of a cluster.

    ``members`` has ``node, digest, cluster, copies, doc_id, block`` and what ``tasks`` needs, the
    pairs of blocks (``first, second``) that a member takes part in.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text).tobytes() for text in batch.column("text").to_pylist()]
            digests = [xxhash.xxh3_128_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(sets, pa.binary())], names=["digest", "shingles"])

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    wanted = keyed(named, members.select("doc_id").distinct(), "left_semi")
    sets = wanted.select("text").mapInArrow(shingles, "digest binary, shingles binary")
    side = F.broadcast(members) if members.count() * MEMBER_BYTES <= BROADCAST_BYTES else members
    dealt = (
        sets.join(side, "digest")
        .select("node", "copies", "cluster", "block", "shingles", F.explode(tasks).alias("task"))
        .select("node", "copies", "cluster", "block", "shingles", "task.first", "task.second")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, done = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["cluster"], row["first"], row["second"])
                if key != current and held:
                    done += _verify(held)
                    held = []
                current = key
                held.append(row)
            if len(done) > 10_000:
                yield pa.RecordBatch.from_pylist(done, schema=_LINKED)
                done = []
        if held:
            done += _verify(held)
        yield pa.RecordBatch.from_pylist(done, schema=_LINKED)

    keys = ["cluster", "first", "second"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "node bigint, root bigint, links bigint")


def link(docs: DataFrame, count: bool = False) -> DataFrame:
    """``doc_id, mark, n_shingles, component_id`` of every row, with ``count`` also ``n_links``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, ``mark`` a hash of the text,
    ``n_links`` the number of rows linked directly; to count them, all members of a cluster have to
    be compared with one another. A null or empty text, or one without words, has no shingles and
    links with nothing: its component is its own ``doc_id``. A text of fewer words than a shingle
    is one shingle. Rows with equal texts link, also if they repeat a ``doc_id``; null ids are
    never smallest. Other columns are not read.
    """
    described = stored(describe(docs), "shown")
    classes = stored(
        described.where("n > 0")
        .groupBy("digest")
        .agg(
            F.first("class").alias("class"),
            F.first("n").alias("n"),
            F.first("below").alias("below"),
            F.count("*").alias("copies"),
            F.min("doc_id").alias("doc_id"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    members = placed(classes.join(clusters(described, classes), "class").drop("class", "below"))
    if count:
        block = F.col("block")
        found = stored(verified(docs, members, _tasks(block, F.lit(0), F.col("blocks") - 1)), "links")
        joined = cc.components(_edges(found))
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
    else:
        joined = connected(docs, members)
    smallest = classes.select("node", "doc_id").join(joined, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = joined.join(smallest, "component").select("node", "component_id")
    groups = classes.select("node", "digest", "copies", "doc_id").join(by_node, "node", "left")
    counted = {}
    if count:
        groups = groups.join(links, "node", "left")
        counted = {"n_links": F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("bigint")}
    groups = groups.where("copies > 1 OR component_id IS NOT NULL").select(
        "digest", F.coalesce("component_id", "doc_id").alias("component_id"), *(c.alias(name) for name, c in counted.items())
    )
    return (
        described.select("doc_id", "mark", "n", "digest")
        .join(groups, "digest", "left")
        .select(
            "doc_id",
            "mark",
            F.col("n").cast("bigint").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
            *(F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in counted),
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group of linked ones, the one with the smallest id, with all columns.

    Rows that share that id and differ in their texts all stay; documents without id stay.
    """
    dropped = stored(
        link(docs).where("doc_id <> component_id").select("doc_id", F.col("mark").alias("__mark")).distinct(),
        "dropped",
    )
    marked = docs.withColumn("__mark", F.xxhash64("text"))
    return keyed(marked, dropped, "left_anti").drop("__mark")
