"""Gradient-boosted trees for a binary label, in numpy: histogram splits, monotonic features, flat node arrays.

``fit`` sees a bounded matrix (the caller states the bound); ``FlatTrees.margin`` walks all rows of a batch
through one tree level at a time, with no Python loop over rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class FlatTrees:
    """All nodes of all trees in five arrays. A leaf points to itself, so every row can take ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            total += self.value[at]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.margin(x)))


def _best_split(codes, rows, grad, hess, bins, monotone, low, high, penalty, min_rows):
    """(gain, feature, bin) of the best split of ``rows``; gain 0 if none helps."""
    best = (1e-9, -1, -1)
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    parent = g_all * g_all / (h_all + penalty)
    for f in range(codes.shape[1]):
        c = codes[rows, f]
        n = np.cumsum(np.bincount(c, minlength=bins))[:-1]
        g = np.cumsum(np.bincount(c, weights=grad[rows], minlength=bins))[:-1]
        h = np.cumsum(np.bincount(c, weights=hess[rows], minlength=bins))[:-1]
        lo = np.clip(-g / (h + penalty), low, high)
        hi = np.clip(-(g_all - g) / (h_all - h + penalty), low, high)
        gain = g * g / (h + penalty) + (g_all - g) ** 2 / (h_all - h + penalty) - parent
        gain[(n < min_rows) | (len(rows) - n < min_rows)] = 0.0
        if monotone[f]:
            gain[(hi - lo) * monotone[f] < 0] = 0.0
        b = int(np.argmax(gain))
        if gain[b] > best[0]:
            best = (float(gain[b]), f, b)
    return best


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: list[int] | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    penalty: float = 1.0,
    min_rows: int = 5,
) -> FlatTrees:
    """Trees for log-odds of ``y``. ``monotone[f]`` of 1 or -1 makes the score rise or fall with feature ``f``.

    With no rows or one class only, the result is a constant.
    """
    monotone = monotone or [0] * x.shape[1]
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node(v: float) -> int:
        k = len(value)
        for column, item in zip((feature, threshold, left, right, value), (0, np.inf, k, k, v)):
            column.append(item)
        return k

    prior = (y.sum() + 1.0) / (len(y) + 2.0) if len(y) else 0.5
    base = float(np.log(prior / (1.0 - prior)))
    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        codes = np.stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(x.shape[1])], axis=1)
        margin = np.full(len(y), base)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-margin))
            grad, hess = p - y, p * (1.0 - p)
            root = node(0.0)
            roots.append(root)
            # a child keeps its values on its side of the parent's middle: the tree stays monotonic as a whole
            stack = [(root, np.arange(len(y)), 0, -np.inf, np.inf)]
            while stack:
                k, rows, level, low, high = stack.pop()
                leaf = float(np.clip(-grad[rows].sum() / (hess[rows].sum() + penalty), low, high))
                gain, f, b = (0.0, -1, -1)
                if level < depth and len(rows) >= 2 * min_rows:
                    gain, f, b = _best_split(codes, rows, grad, hess, bins, monotone, low, high, penalty, min_rows)
                if f < 0 or b >= len(cuts[f]):
                    value[k] = rate * leaf
                    margin[rows] += rate * leaf
                    continue
                goes_left = codes[rows, f] <= b
                lows, highs = [low, low], [high, high]
                if monotone[f]:
                    part = [rows[goes_left], rows[~goes_left]]
                    sides = [np.clip(-grad[r].sum() / (hess[r].sum() + penalty), low, high) for r in part]
                    middle = float(sum(sides)) / 2
                    up = monotone[f] > 0
                    highs[0 if up else 1] = middle
                    lows[1 if up else 0] = middle
                feature[k], threshold[k] = f, float(cuts[f][b])
                left[k], right[k] = node(0.0), node(0.0)
                stack.append((left[k], rows[goes_left], level + 1, lows[0], highs[0]))
                stack.append((right[k], rows[~goes_left], level + 1, lows[1], highs[1]))
    return FlatTrees(
        np.array(feature, dtype=np.int64), np.array(threshold, dtype=float), np.array(left, dtype=np.int64),
        np.array(right, dtype=np.int64), np.array(value, dtype=float), np.array(roots, dtype=np.int64), depth, base,
    )
