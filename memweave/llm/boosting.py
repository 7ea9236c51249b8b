"""Gradient-boosted trees for binary targets in NumPy (helper of HTML extraction)."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Level-wise trees on binned features with logistic loss; a tree is a heap of (feature, bin) with 2 ** depth leaf values."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 16, least: float = 1.0):
        self.n, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        qs = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(col, qs)) if len(np.unique(col)) > self.bins else np.unique(col)[:-1] for col in x.T]
        b = self._binned(x)
        n, f = b.shape
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(n, self.base)
        self.trees = []
        cells = np.arange(f) * self.bins + b  # row, feature -> histogram cell
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p) + 1e-9
            node = np.zeros(n, np.int64)
            split = np.zeros((2 ** self.depth - 1, 2), np.int64)
            split[:, 1] = self.bins  # "all to the left" where nothing is gained
            for level in range(self.depth):
                width = 2 ** level
                key = (node[:, None] * (f * self.bins) + cells).ravel()
                size = width * f * self.bins
                gs = np.bincount(key, np.repeat(g, f), size).reshape(width, f, self.bins).cumsum(2)
                hs = np.bincount(key, np.repeat(h, f), size).reshape(width, f, self.bins).cumsum(2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = gs ** 2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt ** 2 / (ht + 1)
                gain[(hs < self.least) | (ht - hs < self.least)] = 0
                best = gain.reshape(width, -1).argmax(1)
                good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
                own = np.where(good[:, None], np.stack([best // self.bins, best % self.bins], 1), [[0, self.bins]])
                split[width - 1:2 * width - 1] = own
                node = node * 2 + (b[np.arange(n), own[node, 0]] > own[node, 1])
            leaves = 2 ** self.depth
            value = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + 1)
            self.trees.append((split, value))
            score += value[node]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class."""
        b, rows = self._binned(x), np.arange(len(x))
        score = np.full(len(x), self.base)
        for split, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = at * 2 + 1 + (b[rows, split[at, 0]] > split[at, 1])
            score += value[at - (2 ** self.depth - 1)]
        return 1 / (1 + np.exp(-score))
