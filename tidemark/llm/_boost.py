"""Gradient-boosted trees for a logistic loss, on binned features (numpy).

Training takes a bounded table on the driver; the result is a few arrays.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class Trees:
    """``rounds`` trees of ``depth`` levels; a node splits on feature <= cut."""

    def __init__(self, rounds: int = 50, depth: int = 4, rate: float = 0.2, ridge: float = 1.0, least: float = 2.0):
        self.rounds, self.depth, self.rate, self.ridge, self.least = rounds, depth, rate, ridge, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> "Trees":
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
        binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
        flat = binned + BINS * np.arange(m)
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        margin = np.full(n, self.base)
        inner = (1 << self.depth) - 1
        self.feature = np.zeros((self.rounds, inner), np.int64)
        self.cut = np.full((self.rounds, inner), np.inf)
        self.value = np.zeros((self.rounds, 1 << self.depth))
        for r in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, p * (1 - p) + 1e-9
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                width = 1 << level
                key = (node[:, None] * (m * BINS) + flat).ravel()
                shape = (width, m, BINS)
                g = np.bincount(key, np.repeat(grad, m), width * m * BINS).reshape(shape).cumsum(2)
                h = np.bincount(key, np.repeat(hess, m), width * m * BINS).reshape(shape).cumsum(2)
                gt, ht = g[:, :, -1:], h[:, :, -1:]
                gain = g ** 2 / (h + self.ridge) + (gt - g) ** 2 / (ht - h + self.ridge) - gt ** 2 / (ht + self.ridge)
                gain[(h < self.least) | (ht - h < self.least)] = -1
                best = gain.reshape(width, -1).argmax(1)
                at = width - 1
                split = np.full(width, BINS)
                for k in range(width):
                    j, b = divmod(int(best[k]), BINS)
                    if gain[k, j, b] > 1e-9 and b < len(cuts[j]):
                        self.feature[r, at + k], self.cut[r, at + k], split[k] = j, cuts[j][b], b
                column = binned[np.arange(n), self.feature[r, at + node]]
                node = 2 * node + (column > split[node])
            g = np.bincount(node, grad, 1 << self.depth)
            h = np.bincount(node, hess, 1 << self.depth)
            self.value[r] = -self.rate * g / (h + self.ridge)
            margin += self.value[r][node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = (1 << level) - 1 + node
                node = 2 * node + (x[rows, feature[at]] > cut[at])
            out += value[node]
        return out
