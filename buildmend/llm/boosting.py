"""Gradient-boosted trees for binary labels on dense features, in numpy."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Complete binary trees of one depth, as arrays of splits and leaves."""

    def __init__(self, depth: int = 4, trees: int = 60, rate: float = 0.25, bins: int = 32, ridge: float = 1.0):
        self.depth, self.trees, self.rate, self.bins, self.ridge = depth, trees, rate, bins, ridge
        self.start, self.splits, self.leaves = 0.0, [], []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
        n, width = x.shape
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1], method="nearest")) for f in range(width)]
        binned = np.column_stack([np.searchsorted(cuts[f], x[:, f], side="left") for f in range(width)])
        share = float(np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3))
        self.start = float(np.log(share / (1 - share)))
        margin, inner = np.full(n, self.start), 2**self.depth - 1
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = weight * (p - y), weight * p * (1 - p)
            feature, value, at = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(n, dtype=np.int64)
            for level in range(self.depth):
                first, count = 2**level - 1, 2**level
                node = at - first
                best = np.full(count, 1e-6)
                for f in range(width):
                    k = len(cuts[f]) + 1
                    if k == 1:
                        continue
                    key = node * k + binned[:, f]
                    gs = np.bincount(key, weights=g, minlength=count * k).reshape(count, k)
                    hs = np.bincount(key, weights=h, minlength=count * k).reshape(count, k)
                    gl, hl = gs.cumsum(axis=1)[:, :-1], hs.cumsum(axis=1)[:, :-1]
                    ga, ha = gs.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
                    gain = gl**2 / (hl + self.ridge) + (ga - gl) ** 2 / (ha - hl + self.ridge) - ga**2 / (ha + self.ridge)
                    top = gain.argmax(axis=1)
                    most = gain[np.arange(count), top]
                    better = most > best
                    best[better] = most[better]
                    feature[first : first + count][better] = f
                    value[first : first + count][better] = cuts[f][top[better]]
                at = 2 * at + 1 + (x[np.arange(n), feature[at]] > value[at])
            leaf = at - inner
            gs, hs = np.bincount(leaf, weights=g, minlength=inner + 1), np.bincount(leaf, weights=h, minlength=inner + 1)
            leaves = -self.rate * gs / (hs + self.ridge)
            margin += leaves[leaf]
            self.splits.append((feature, value))
            self.leaves.append(leaves)
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 for each row."""
        out, rows, inner = np.full(len(x), self.start), np.arange(len(x)), 2**self.depth - 1
        for (feature, value), leaves in zip(self.splits, self.leaves):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > value[at])
            out += leaves[at - inner]
        return out
