"""Vantage-point trees over 64-bit fingerprints under Hamming distance.

A split has a vantage point and a radius: points within the radius are inside, the others outside. If
two points are at most ``reach`` apart, their distances to any vantage point differ by at most ``reach``,
so of two points on different sides, the inner one lies in the strip just within the radius. Only points
of the strip need to visit the other side.

The top levels of the tree deal points out to leaves (one Spark task each); each leaf searches its
points with the same splits, in numpy, down to small blocks that are compared directly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DIRECT = 1 << 16
CELLS = 1 << 21
#: Groups (leaves, and pairs of blocks of a leaf) that a tree is cut back to at most, so that no core is idle.
GROUPS = 64
#: A deeper tree compares fewer points, so it is worth so many times the rows of the cheapest one.
WORTH = 1.1


def distance(points: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(points ^ vantage)


def best_split(points: np.ndarray, reach: int, tries: int = 8) -> tuple[np.uint64, int]:
    """Vantage point and radius with the thinnest strip, among radii that part the points fairly."""
    best = None
    for place in np.linspace(0, len(points) - 1, min(tries, len(points))).astype(int):
        counts = np.cumsum(np.bincount(distance(points, points[place]), minlength=65))
        for radius in range(64):
            inside = counts[radius]
            if min(inside, len(points) - inside) < 0.2 * len(points):
                continue
            strip = inside - (counts[radius - reach] if radius >= reach else 0)
            cost = strip + abs(inside - len(points) / 2)
            if best is None or cost < best[0]:
                best = (cost, points[place], radius)
    if best is None:  # nearly all points have one distance
        return points[0], int(np.median(distance(points, points[0])))
    return best[1], best[2]


@dataclass
class Tree:
    """A full binary tree in heap order; leaves are numbered from 0."""

    vantages: np.ndarray
    radii: np.ndarray
    depth: int
    reach: int
    #: Into how many blocks the points of a leaf are cut, so that no task holds a large leaf.
    blocks: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int, reach: int, scale: float, block: int) -> Tree:
        """``scale`` is how many points each point of the sample stands for."""
        nodes = (1 << depth) - 1
        tree = cls(np.zeros(nodes, np.uint64), np.full(nodes, 64, np.int16), depth, reach, np.ones(1 << depth, np.int64))
        held = {0: sample}
        for node in range(nodes):
            points = held.pop(node, sample[:0])
            if len(points):
                tree.vantages[node], tree.radii[node] = best_split(points, reach)
            inside = distance(points, tree.vantages[node]) <= tree.radii[node]
            held[2 * node + 1], held[2 * node + 2] = points[inside], points[~inside]
        return tree._cut(sample, scale, block)

    def _cut(self, sample: np.ndarray, scale: float, block: int) -> Tree:
        """The tree at the depth that moves few rows: a level less means fewer visits, but more blocks, and every
        row of a leaf goes to each of its blocks."""
        trees = []
        for depth in range(self.depth + 1):
            nodes = (1 << depth) - 1
            tree = Tree(self.vantages[:nodes], self.radii[:nodes], depth, self.reach, np.ones(1 << depth, np.int64))
            rows = np.bincount(tree.route(sample)[1], minlength=1 << depth) * scale
            tree.blocks = np.maximum(1, np.ceil(rows / block)).astype(np.int64)
            groups = int((tree.blocks * (tree.blocks + 1) // 2).sum())
            trees.append((depth, float((rows * tree.blocks).sum()), groups, tree))
        enough = min(GROUPS, trees[-1][2])
        wide = [x for x in trees if x[2] >= enough]
        least = min(x[1] for x in wide)
        return max((x for x in wide if x[1] <= WORTH * least), key=lambda x: x[0])[3]

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the point, leaf, and whether the leaf is its home, for all leaves that it must visit."""
        at = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        home = np.ones(len(points), bool)
        for _ in range(self.depth):
            far = distance(points[at], self.vantages[node]).astype(np.int64)
            radius = self.radii[node].astype(np.int64)
            inside = far <= radius
            near_out = far > radius - self.reach  # may have neighbours outside
            near_in = far <= radius + self.reach
            stay_in = np.where(home, inside, near_in)
            stay_out = np.where(home, ~inside, near_out)
            visit_out = home & inside & near_out
            at = np.concatenate([at[stay_in], at[stay_out], at[visit_out]])
            node = np.concatenate([2 * node[stay_in] + 1, 2 * node[stay_out] + 2, 2 * node[visit_out] + 2])
            home = np.concatenate([home[stay_in], home[stay_out], np.zeros(visit_out.sum(), bool)])
        return at, node - ((1 << self.depth) - 1), home


class Groups:
    """Which points hang together so far; each group is known by its smallest index."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, of: np.ndarray) -> np.ndarray:
        root = self.parent[of]
        while True:
            above = self.parent[root]
            if np.array_equal(above, root):
                self.parent[of] = root
                return root
            root = above

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.roots(a), self.roots(b)
        while True:
            apart = a != b
            if not apart.any():
                return
            high, low = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            np.minimum.at(self.parent, high, low)
            a, b = self.roots(high), self.roots(low)


class Search:
    """Joins all pairs of points at most ``reach`` apart."""

    def __init__(self, points: np.ndarray, reach: int):
        self.points, self.reach, self.groups = points, reach, Groups(len(points))

    def _direct(self, a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, CELLS // max(1, len(b)))
        for start in range(0, len(a), step):
            part = a[start : start + step]
            near = distance(self.points[part][:, None], self.points[b][None, :]) <= self.reach
            i, j = np.nonzero(near)
            self.groups.join(part[i], b[j])

    def within(self, a: np.ndarray) -> None:
        """Pairs of two points of ``a``."""
        if len(a) <= 256:
            if len(a) > 1:
                self._direct(a, a)
            return
        vantage, radius = best_split(self.points[a], self.reach, tries=3)
        far = distance(self.points[a], vantage).astype(np.int64)
        inside = far <= radius
        if inside.all() or not inside.any():
            self._direct(a, a)
            return
        self.within(a[inside])
        self.within(a[~inside])
        self.between(a[inside & (far > radius - self.reach)], a[~inside & (far <= radius + self.reach)])

    def between(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of a point of ``a`` and one of ``b``."""
        if not len(a) or not len(b):
            return
        if len(a) * len(b) <= DIRECT:
            self._direct(a, b)
            return
        vantage, radius = best_split(self.points[a if len(a) >= len(b) else b], self.reach, tries=3)
        far_a = distance(self.points[a], vantage).astype(np.int64)
        far_b = distance(self.points[b], vantage).astype(np.int64)
        in_a, in_b = far_a <= radius, far_b <= radius
        out_strip, in_strip = radius + self.reach, radius - self.reach
        parts = [
            (a[in_a], b[in_b]),
            (a[~in_a], b[~in_b]),
            (a[in_a & (far_a > in_strip)], b[~in_b & (far_b <= out_strip)]),
            (a[~in_a & (far_a <= out_strip)], b[in_b & (far_b > in_strip)]),
        ]
        if sum(len(x) * len(y) for x, y in parts) > 0.8 * len(a) * len(b):
            self._direct(a, b)
            return
        for x, y in parts:
            self.between(x, y)
