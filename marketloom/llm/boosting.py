"""Gradient-boosted trees on a small table of feature cells, scored as a SQL expression.

Features are small integers, so all rows of a corpus fall into a bounded number of cells; the trees
are grown on the cells with their counts, which is the same as growing them on the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 24
DEPTH = 3
RATE = 0.3
SMOOTHING = 1.0


@dataclass(frozen=True)
class Split:
    feature: int
    upto: int  # values up to this one go to the left
    left: Split | float
    right: Split | float


@dataclass
class Boosted:
    """A sum of trees; ``thresholds`` holds, per kind, the score from which a candidate is taken."""

    names: Sequence[str]
    base: float
    trees: list[Split | float]
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, x: np.ndarray) -> np.ndarray:
        def walk(node, rows):
            if not isinstance(node, Split):
                out[rows] += node
                return
            left = x[rows, node.feature] <= node.upto
            walk(node.left, rows[left])
            walk(node.right, rows[~left])

        out = np.full(len(x), self.base)
        for tree in self.trees:
            walk(tree, np.arange(len(x)))
        return out

    def expression(self, column) -> Column:
        """The score as a Spark expression; ``column`` maps a feature name to its column."""

        def walk(node) -> Column:
            if not isinstance(node, Split):
                return F.lit(float(node))
            return F.when(column(self.names[node.feature]) <= node.upto, walk(node.left)).otherwise(walk(node.right))

        total = F.lit(float(self.base))
        for tree in self.trees:
            total = total + walk(tree)
        return total


def _grow(x: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, rows: np.ndarray, depth: int) -> Split | float:
    g, h = gradient[rows].sum(), curvature[rows].sum()
    leaf = float(RATE * g / (h + SMOOTHING))
    best, cut = 1e-9, None
    if depth:
        for f in range(x.shape[1]):
            values = x[rows, f]
            for upto in np.unique(values)[:-1]:
                left = values <= upto
                gl, hl = gradient[rows[left]].sum(), curvature[rows[left]].sum()
                gain = gl**2 / (hl + SMOOTHING) + (g - gl) ** 2 / (h - hl + SMOOTHING) - g**2 / (h + SMOOTHING)
                if gain > best:
                    best, cut = gain, (f, int(upto), left)
    if cut is None:
        return leaf
    f, upto, left = cut
    return Split(
        f, upto,
        _grow(x, gradient, curvature, rows[left], depth - 1),
        _grow(x, gradient, curvature, rows[~left], depth - 1),
    )


def fit(names: Sequence[str], x: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Boosted | None:
    """Logistic boosting; None if there is only one class."""
    share = float((label * weight).sum() / max(weight.sum(), 1e-9))
    if not 0 < share < 1:
        return None
    model = Boosted(names, math.log(share / (1 - share)), [])
    total = np.full(len(x), model.base)
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-total))
        tree = _grow(x, weight * (label - chance), weight * chance * (1 - chance), np.arange(len(x)), DEPTH)
        model.trees.append(tree)
        total = total + Boosted(names, 0.0, [tree]).score(x)
    return model


def calibrate(model: Boosted, kind: np.ndarray, x: np.ndarray, label: np.ndarray, weight: np.ndarray, precision: float) -> None:
    """Per kind, the smallest score from which held-out candidates reach the precision; none if no score does."""
    score = model.score(x)
    for k in np.unique(kind):
        here = kind == k
        for threshold in np.unique(score[here]):
            taken = here & (score >= threshold)
            if (label * weight)[taken].sum() >= precision * weight[taken].sum():
                model.thresholds[int(k)] = float(threshold)
                break
