"""Gradient boosting of small trees over a table of feature cells.

Features are small whole numbers, so all rows fall into a bounded number of cells; the trees are fitted
on the cells with their counts of positive and negative rows, which is the same as fitting them on all
rows. The table of cells is small; everything here works on it alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

ROUNDS = 24
RATE = 0.3
SHRINK = 1.0


@dataclass
class Tree:
    """Nested: ``feature <= cut`` goes left; a leaf has a value only."""

    value: float = 0.0
    feature: int = -1
    cut: int = 0
    left: Tree | None = None
    right: Tree | None = None

    def score(self, cell: tuple[int, ...]) -> float:
        if self.left is None:
            return self.value
        return (self.left if cell[self.feature] <= self.cut else self.right).score(cell)


def _grow(rows: list[tuple[tuple[int, ...], float, float]], depth: int) -> Tree:
    """``rows``: cell, gradient, curvature."""
    total, bend = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = Tree(RATE * total / (bend + SHRINK))
    if not depth or not rows:
        return leaf
    best, gain = None, 1e-6
    for feature in range(len(rows[0][0])):
        sums: dict[int, list[float]] = {}
        for cell, g, h in rows:
            held = sums.setdefault(cell[feature], [0.0, 0.0])
            held[0] += g
            held[1] += h
        g = h = 0.0
        for cut in sorted(sums)[:-1]:
            g += sums[cut][0]
            h += sums[cut][1]
            here = g * g / (h + SHRINK) + (total - g) ** 2 / (bend - h + SHRINK) - total * total / (bend + SHRINK)
            if here > gain:
                best, gain = (feature, cut), here
    if best is None:
        return leaf
    feature, cut = best
    left = [r for r in rows if r[0][feature] <= cut]
    right = [r for r in rows if r[0][feature] > cut]
    return Tree(0.0, feature, cut, _grow(left, depth - 1), _grow(right, depth - 1))


def boosted(cells: dict[tuple[int, ...], tuple[float, float]], depth: int = 3) -> tuple[float, list[Tree]]:
    """Starting score and trees, from the positive and negative rows of each cell.

    Both classes count the same in total; a class without rows leaves the other's score at its start.
    """
    positive, negative = (sum(x[i] for x in cells.values()) for i in (0, 1))
    if not positive or not negative:
        return (4.0 if positive else -4.0), []
    mass = 1000.0
    weights = {cell: (mass * p / positive, mass * n / negative) for cell, (p, n) in cells.items() if p or n}
    scores = dict.fromkeys(weights, 0.0)
    trees = []
    for _ in range(ROUNDS):
        rows = []
        for cell in sorted(weights):
            p, n = weights[cell]
            chance = 1 / (1 + math.exp(-scores[cell]))
            rows.append((cell, p * (1 - chance) - n * chance, (p + n) * chance * (1 - chance)))
        trees.append(_grow(rows, depth))
        for cell in scores:
            scores[cell] += trees[-1].score(cell)
    return 0.0, trees


def threshold(scored: list[tuple[float, float, float]], precision: float, recall: float) -> float:
    """The lowest score from which on ``precision`` of the labelled rows are positive, but no lower than what
    ``recall`` of the positive rows reach; infinity if there is none. ``scored``: score, positive, negative."""
    positive = sum(x[1] for x in scored)
    best, p, n = float("inf"), 0.0, 0.0
    for value in sorted({x[0] for x in scored}, reverse=True):
        p += sum(x[1] for x in scored if x[0] == value)
        n += sum(x[2] for x in scored if x[0] == value)
        if p and p >= precision * (p + n):
            best = value
        if positive and p >= recall * positive:
            break
    return best
