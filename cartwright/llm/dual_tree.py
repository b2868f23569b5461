"""Nearest entries of many integer points by a tree over the points and a tree over the entries.

Both trees are balanced and kept as arrays, level by level, with the box of every node; nodes of
points also hold the sum of their points. Pairs of nodes are bounded from their boxes, for all
open nodes of a level at once: an entry node is dropped where its least distance is more than the
greatest distance of another one, a single entry where the whole box lies on the other side of
the plane between it and the best one. A node with one entry left is assigned as a whole; points
of open leaves are compared with the entries left, in whole numbers. All bounds are whole numbers
too, so the result equals comparing everything: ties go to the lower index.
"""

from __future__ import annotations

import numpy as np

POINT_LEAF = 32


def bounds(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin and end in the order of a tree of n points."""
    return (np.arange((1 << level) + 1) * n) >> level


class Tree:
    """A balanced tree. ``order`` lists the points as the leaves hold them; ``low``, ``high`` and
    ``sums`` have one array per level."""

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        self.depth = max(0, int(np.ceil(np.log2(max(n, 1) / leaf))))
        order = np.arange(n)
        for level in range(self.depth):
            cut = bounds(n, level)
            now = points[order]
            wide = np.argmax(np.maximum.reduceat(now, cut[:-1]) - np.minimum.reduceat(now, cut[:-1]), axis=1)
            node = np.repeat(np.arange(len(wide)), np.diff(cut))
            order = order[np.lexsort((now[np.arange(n), wide[node]], node))]
        self._set(order, points[order])

    def _set(self, order: np.ndarray, points: np.ndarray) -> None:
        self.order, self.points = order, points
        cut = bounds(len(points), self.depth)[:-1]
        low, high, sums = (f.reduceat(points, cut) for f in (np.minimum, np.maximum, np.add))
        self.low, self.high, self.sums = [low], [high], [sums]
        for _ in range(self.depth):
            low, high, sums = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]), sums[::2] + sums[1::2]
            self.low.insert(0, low)
            self.high.insert(0, high)
            self.sums.insert(0, sums)


class Entries:
    """The entries of a codebook with their tree, down to single entries. To fill the last level,
    some entries stand in it twice; they are the same place, so bounds stay right."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        full = 1 << int(np.ceil(np.log2(len(entries))))
        which = np.arange(full) % len(entries)
        self.tree = Tree(entries[which], 1)
        self.index = which[self.tree.order]
        self.real = self.tree.order < len(entries)
        self.norm = (entries * entries).sum(axis=1)


def _left_over(low: np.ndarray, high: np.ndarray, open_: np.ndarray, book: Entries) -> np.ndarray:
    """Of the entries open for each box (boxes x entries), those that may be nearest to a point in it."""
    tree, m = book.tree, len(low)
    box, node = np.arange(m), np.zeros(m, np.int64)
    at_leaves = open_[:, book.index] & book.real
    greatest = None
    for level in range(tree.depth + 1):
        if level:
            box, node = np.repeat(box, 2), (2 * node[:, None] + [0, 1]).ravel()
        there = at_leaves.reshape(m, 1 << level, -1).any(axis=2)[box, node]
        box, node = box[there], node[there]
        e_low, e_high = tree.low[level][node], tree.high[level][node]
        gap = np.maximum(0, np.maximum(e_low - high[box], low[box] - e_high))
        reach = np.maximum(high[box] - e_low, e_high - low[box])
        greatest = (reach * reach).sum(axis=1)
        first = np.flatnonzero(np.append(True, box[1:] != box[:-1]))
        near = (gap * gap).sum(axis=1) <= np.minimum.reduceat(greatest, first)[box]
        box, node, greatest = box[near], node[near], greatest[near]
    entry = book.index[node]
    first = np.flatnonzero(np.append(True, box[1:] != box[:-1]))
    is_best = greatest == np.minimum.reduceat(greatest, first)[box]
    best = np.zeros(m, np.int64)
    best[box[is_best]] = entry[is_best]
    other = best[box]
    apart = 2 * (book.entries[entry] - book.entries[other])
    behind = book.norm[other] - book.norm[entry] + np.maximum(low[box] * apart, high[box] * apart).sum(axis=1)
    lost = (behind < 0) | ((behind == 0) & (entry > other))
    out = np.zeros_like(open_)
    out[box[~lost], entry[~lost]] = True
    return out


def assign(points: Tree, book: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each point in the order of the tree, points of each entry, their sums)."""
    n, k = len(points.points), len(book.entries)
    found = np.zeros(n, np.int64)
    count, sums = np.zeros(k, np.int64), np.zeros((k, points.points.shape[1]), np.int64)
    node, open_ = np.zeros(1, np.int64), np.ones((1, k), bool)
    for level in range(points.depth + 1):
        open_ = _left_over(points.low[level][node], points.high[level][node], open_, book)
        cut = bounds(n, level)
        sole = open_.sum(axis=1) == 1
        entry, whole = np.argmax(open_[sole], axis=1), node[sole]
        size = cut[whole + 1] - cut[whole]
        found[_spans(cut[whole], size)] = np.repeat(entry, size)
        np.add.at(count, entry, size)
        np.add.at(sums, entry, points.sums[level][whole])
        node, open_ = node[~sole], open_[~sole]
        if not len(node):
            return found, count, sums
        if level < points.depth:
            node, open_ = (2 * node[:, None] + [0, 1]).ravel(), np.repeat(open_, 2, axis=0)
    size = cut[node + 1] - cut[node]
    spot, leaf = _spans(cut[node], size), np.repeat(np.arange(len(node)), size)
    # Squared distances, less the square of the point, which is the same for all entries.
    distance = book.norm - 2 * (points.points[spot] @ book.entries.T)
    entry = np.argmin(np.where(open_[leaf], distance, np.iinfo(np.int64).max), axis=1)
    found[spot] = entry
    count += np.bincount(entry, minlength=k)
    np.add.at(sums, entry, points.points[spot])
    return found, count, sums


def _spans(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
