"""Collinear chaining of matches between two texts, and the similarity of what a chain spans."""

from __future__ import annotations

import numpy as np


class PrefixMax:
    """Fenwick tree of (value, owner) under prefix maximum."""

    def __init__(self, size: int):
        self.value = [-np.inf] * (size + 1)
        self.owner = [-1] * (size + 1)

    def put(self, at: int, value: float, owner: int) -> None:
        at += 1
        while at < len(self.value):
            if value > self.value[at]:
                self.value[at], self.owner[at] = value, owner
            at += at & -at

    def best(self, count: int) -> tuple[float, int]:
        """The largest value among the first ``count`` places."""
        value, owner = -np.inf, -1
        while count > 0:
            if self.value[count] > value:
                value, owner = self.value[count], self.owner[count]
            count -= count & -count
        return value, owner


def segments(group: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of matches of a group on one diagonal, each at most ``reach`` words after the one before: the group, and (x start, x end, y start, y end)."""
    order = np.lexsort((x, x - y, group))
    group, x, y = group[order], x[order], y[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (np.diff(group) != 0) | (np.diff(x - y) != 0) | (np.diff(x) > reach)
    first = np.flatnonzero(new)
    last = np.append(first, len(x))[1:] - 1
    return group[first], np.stack([x[first], x[last] + k, y[first], y[last] + k], axis=1)


def chains(runs: np.ndarray, gap_cost: float) -> list[np.ndarray]:
    """Collinear chains of runs, best first; no run is in two.

    A run scores its words; a step from run j to run i costs ``gap_cost`` for every word skipped on either side. The cost splits into a part
    of j and a part of i, so the best predecessor is a prefix maximum over the ends in y of the runs that end before i in x.
    """
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    n = len(runs)
    if n == 1:
        return [runs]
    ends_y = np.unique(runs[:, 3])
    place = np.searchsorted(ends_y, runs[:, 3]).tolist()
    reachable = np.searchsorted(ends_y, runs[:, 2], side="right").tolist()
    by_end = np.argsort(runs[:, 1], kind="stable").tolist()
    tree = PrefixMax(len(ends_y))
    score, before = [0.0] * n, [-1] * n
    waiting = 0
    for i in range(n):
        x0, x1, y0, y1 = runs[i].tolist()
        while waiting < n and runs[by_end[waiting], 1] <= x0:
            j = by_end[waiting]
            if j < i:
                tree.put(place[j], score[j] + gap_cost * float(runs[j, 1] + runs[j, 3]), j)
            waiting += 1
        value, owner = tree.best(reachable[i])
        gained = value - gap_cost * (x0 + y0)
        score[i] = float(x1 - x0) + max(0.0, gained)
        before[i] = owner if gained > 0 else -1
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(runs[chain[::-1]])
    return out


def common_words(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    if a == b:
        return len(a)
    masks: dict[bytes, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        both = row & masks.get(w, 0)
        row = (row + both | row - both) & full
    return len(a) - row.bit_count()


def extension(a: list[bytes], b: list[bytes], drop: int = 8) -> int:
    """How many leading words two stretches share, differences included that later matches make up for."""
    best = keep = at = score = 0
    for u, v in zip(a, b):
        at += 1
        score += 1 if u == v else -1
        if u == v and score > best:  # ends on a match
            best, keep = score, at
        elif score <= best - drop:
            break
    return keep
