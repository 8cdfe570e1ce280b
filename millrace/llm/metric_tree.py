"""Anchors-hierarchy metric trees: balls of points that cache their sums and counts.

A tree is built from the middle. Anchors are picked one after another, each the point farthest
from the anchor that owns it, and take over every point nearer to them. Balls of anchors are
then merged upwards, the two that fit into the smallest ball first, and every anchor's own points
are divided downwards in the same way until few are left.

A ball that is nearer to one entry than to any other, wherever in it a point may lie, is handed
over whole: its sum and count are known. Entries that cannot win anywhere in a ball are struck
from its list, and its children inherit the shorter list. Only the points of leaves where several
entries are left are compared one by one, in whole numbers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Points a leaf may hold.
LEAF = 32
#: Coordinates below this keep every squared distance exact in 64 bits and the margins valid.
LARGEST = 1 << 26


def node_type(width: int) -> np.dtype:
    return np.dtype(
        [
            ("start", "<i4"),
            ("stop", "<i4"),
            ("left", "<i4"),
            ("right", "<i4"),
            ("radius", "<f8"),
            ("centre", "<f8", (width,)),
            ("sum", "<i8", (width,)),
        ]
    )


@dataclass
class Tree:
    """``order`` lists the points so that every node has one stretch of it; node 0 is the root."""

    order: np.ndarray
    nodes: np.ndarray


def build(points: np.ndarray) -> Tree:
    """The tree of whole-number points (n x width, n at least 1)."""
    floats = points.astype(np.float64)
    children: list[tuple[int, int]] = []
    members: list[np.ndarray | None] = []

    def leaf(index: np.ndarray) -> int:
        children.append((-1, -1))
        members.append(index)
        return len(children) - 1

    def divide(index: np.ndarray) -> int:
        if len(index) <= LEAF:
            return leaf(index)
        owner, count = _anchors(floats[index], math.isqrt(len(index)))
        if count == 1:
            return leaf(index)
        own = [index[owner == anchor] for anchor in range(count)]
        balls = [divide(part) for part in own]
        for left, right in _merges([floats[part] for part in own]):
            children.append((balls[left], balls[right]))
            members.append(None)
            balls[left] = len(children) - 1
        return len(children) - 1

    return _laid_out(points, floats, divide(np.arange(len(points))), children, members)


def _anchors(points: np.ndarray, most: int) -> tuple[np.ndarray, int]:
    """The anchor that owns each point, and how many there are; fewer where points coincide."""
    owner = np.zeros(len(points), dtype=np.int64)
    distance = _squares(points, points[0])
    count = 1
    while count < most:
        farthest = int(np.argmax(distance))
        if distance[farthest] == 0:
            break
        new = _squares(points, points[farthest])
        taken = new < distance
        owner[taken] = count
        distance[taken] = new[taken]
        count += 1
    return owner, count


def _merges(parts: list[np.ndarray]) -> list[tuple[int, int]]:
    """Which two balls to merge next, the smallest common ball first; the first keeps the result."""
    counts = np.array([len(part) for part in parts], dtype=np.float64)
    centres = np.array([part.mean(axis=0) for part in parts])
    radii = np.array([math.sqrt(_squares(part, c).max()) for part, c in zip(parts, centres)])
    alive = np.full(len(parts), True)
    size = np.sqrt(((centres[:, None] - centres) ** 2).sum(axis=-1)) + radii[:, None] + radii
    np.fill_diagonal(size, np.inf)
    merges = []
    for _ in range(len(parts) - 1):
        left, right = divmod(int(np.argmin(size)), len(parts))
        merges.append((left, right))
        both = counts[left] + counts[right]
        centre = (centres[left] * counts[left] + centres[right] * counts[right]) / both
        radii[left] = max(
            math.dist(centre, centres[left]) + radii[left], math.dist(centre, centres[right]) + radii[right]
        )
        centres[left], counts[left], alive[right] = centre, both, False
        size[right], size[:, right] = np.inf, np.inf
        row = np.where(alive, np.sqrt(_squares(centres, centre)) + radii + radii[left], np.inf)
        row[left] = np.inf
        size[left], size[:, left] = row, row
    return merges


def _laid_out(
    points: np.ndarray, floats: np.ndarray, root: int, children: list[tuple[int, int]], members: list[np.ndarray | None]
) -> Tree:
    nodes = np.zeros(len(children), dtype=node_type(points.shape[1]))
    order: list[np.ndarray] = []
    filled = made = 0
    waiting = [(root, -1, "left")]
    while waiting:
        ball, parent, side = waiting.pop()
        place, made = made, made + 1
        nodes[place]["start"] = filled
        nodes[place]["left"] = nodes[place]["right"] = -1
        if parent >= 0:
            nodes[parent][side] = place
        index = members[ball]
        if index is not None:
            order.append(index)
            filled += len(index)
        else:
            left, right = children[ball]
            waiting += [(right, place, "right"), (left, place, "left")]
    # In this order a node's stretch ends where that of its last descendant does.
    stop = np.zeros(made, dtype=np.int64)
    sizes = iter([len(index) for index in order])
    for place in range(made):
        if nodes[place]["left"] < 0:
            stop[place] = nodes[place]["start"] + next(sizes)
    for place in range(made - 1, -1, -1):
        if nodes[place]["left"] >= 0:
            stop[place] = stop[nodes[place]["right"]]
    nodes["stop"] = stop
    placed = np.concatenate(order)
    sums = np.vstack([np.zeros((1, points.shape[1]), dtype=np.int64), np.cumsum(points[placed], axis=0)])
    nodes["sum"] = sums[nodes["stop"]] - sums[nodes["start"]]
    sizes = nodes["stop"] - nodes["start"]
    nodes["centre"] = nodes["sum"] / sizes[:, None]
    within = _stretches(nodes["start"], sizes)
    apart = floats[placed[within]] - np.repeat(nodes["centre"], sizes, axis=0)
    firsts = np.cumsum(sizes) - sizes
    nodes["radius"] = np.sqrt(np.maximum.reduceat((apart**2).sum(axis=1), firsts))
    return Tree(placed, nodes)


def _squares(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    apart = points - to
    return np.einsum("ij,ij->i", apart, apart)


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of several stretches, one stretch after another."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


def owned(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Who owns what: ``(balls, their entries, points, their entries)``.

    A point goes to the nearest entry, ties to the lowest index. ``points`` are in table order.
    """
    nodes, places = tree.nodes, entries.astype(np.float64)
    between = np.sqrt(((places[:, None] - places) ** 2).sum(axis=-1))
    twins = (entries[:, None] == entries).all(axis=-1)
    first_of_twins = np.argmax(twins, axis=1) == np.arange(len(entries))
    front = np.zeros(1, dtype=np.int64)
    lists = first_of_twins[None, :]
    balls, ball_entries, singles, single_entries = [], [], [], []
    while len(front):
        node = nodes[front]
        squares = ((node["centre"][:, None] - places) ** 2).sum(axis=-1)
        squares[~lists] = np.inf
        best = squares.argmin(axis=1)
        least = squares[np.arange(len(front)), best][:, None]
        reach = node["radius"][:, None]
        lead = squares - least - 2 * reach * between[best]
        margin = 1e-9 * (np.where(lists, squares, 0) + least + 4 * reach * reach) + 1e-6 * (1 + reach)
        lists = lists & ~(lead > margin)
        alone = lists.sum(axis=1) == 1
        balls.append(front[alone])
        ball_entries.append(best[alone])
        ends = ~alone & (node["left"] < 0)
        if ends.any():
            sizes = (node["stop"] - node["start"])[ends]
            index = tree.order[_stretches(node["start"][ends], sizes)]
            singles.append(index)
            single_entries.append(_nearest(points[index], entries, np.repeat(lists[ends], sizes, axis=0)))
        inner = ~alone & (node["left"] >= 0)
        front = np.concatenate([node["left"][inner], node["right"][inner]])
        lists = np.concatenate([lists[inner], lists[inner]])
    nothing = [np.empty(0, dtype=np.int64)]
    return tuple(np.concatenate(part or nothing) for part in (balls, ball_entries, singles, single_entries))


def _nearest(points: np.ndarray, entries: np.ndarray, lists: np.ndarray) -> np.ndarray:
    squares = ((points[:, None] - entries) ** 2).sum(axis=-1)
    return np.where(lists, squares, np.iinfo(np.int64).max).argmin(axis=1)


def summed(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the points of each entry."""
    sums = np.zeros(entries.shape, dtype=np.int64)
    counts = np.zeros(len(entries), dtype=np.int64)
    balls, ball_entries, singles, single_entries = owned(tree, points, entries)
    held = tree.nodes[balls]
    np.add.at(sums, ball_entries, held["sum"])
    np.add.at(counts, ball_entries, held["stop"] - held["start"])
    np.add.at(sums, single_entries, points[singles])
    np.add.at(counts, single_entries, 1)
    return sums, counts


def assigned(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The entry of each point, in table order."""
    result = np.empty(len(points), dtype=np.int64)
    balls, ball_entries, singles, single_entries = owned(tree, points, entries)
    held = tree.nodes[balls]
    sizes = held["stop"] - held["start"]
    result[tree.order[_stretches(held["start"], sizes)]] = np.repeat(ball_entries, sizes)
    result[singles] = single_entries
    return result
