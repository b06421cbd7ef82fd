"""Gradient-boosted regression trees for binary labels, in numpy: small, deterministic, trained on the driver."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, histogram splits level by level; a leaf has a sum of second derivatives of at least ``least``. Deterministic for given rows."""

    def __init__(self, rounds: int = 60, depth: int = 4, rate: float = 0.2, least: float = 1.0, bins: int = 32, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.least, self.bins, self.l2 = rounds, depth, rate, least, bins, l2

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x, y = np.asarray(x, np.float32), np.asarray(y, np.float64)
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1], method="nearest")) for c in x.T]
        self.used = np.flatnonzero([len(c) and v.min() <= c[0] < v.max() for c, v in zip(self.cuts, x.T)])  # the others split nothing
        b = np.stack([np.searchsorted(self.cuts[f], x[:, f], "left") for f in self.used], axis=1) if len(self.used) else np.zeros((len(y), 0), np.int64)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        score = np.full(len(y), self.base)
        self.trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, add = self._grow(b, p - y, np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            score += add
        return self

    def _grow(self, b: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], np.ndarray]:
        """A tree and what it adds to each row's score. Histograms of all nodes of a level and all features are counted at once."""
        size, (n, m) = 1 << self.depth, b.shape
        feature, cut, value = np.full(size, -1), np.zeros(size, np.float32), np.zeros(size << 1)
        node = np.ones(n, np.int64)
        if not m:
            return (feature, cut, value), value[np.ones(n, np.int64)]
        at = np.arange(m) * self.bins
        flat = b + at
        last = np.array([len(self.cuts[f]) for f in self.used])
        for level in range(self.depth):
            first = 1 << level
            open_ = np.flatnonzero((node >= first) & (node < 2 * first))  # rows whose node can still be split
            if not len(open_):
                break
            slot = ((node[open_] - first)[:, None] * (m * self.bins) + flat[open_]).ravel()
            total = first * m * self.bins
            gs, hs = (np.cumsum(np.bincount(slot, np.repeat(w[open_], m), total).reshape(first, m, self.bins), axis=2) for w in (g, h))
            sg, sh = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + self.l2) + (sg - gs) ** 2 / (sh - hs + self.l2) - sg**2 / (sh + self.l2)
            gain[(hs < self.least) | (sh - hs < self.least)] = -1
            gain[:, np.arange(self.bins)[None, :] >= last[:, None]] = -1
            gain = gain.reshape(first, -1)
            best = gain.argmax(axis=1)
            for j in np.flatnonzero(gain[np.arange(first), best] > 1e-6):
                f, c = divmod(int(best[j]), self.bins)
                feature[first + j], cut[first + j] = self.used[f], self.cuts[self.used[f]][c]
                rows = open_[node[open_] == first + j]
                node[rows] = 2 * (first + j) + (b[rows, f] > c)
        gs, hs = np.bincount(node, g, size << 1), np.bincount(node, h, size << 1)
        value = -gs / (hs + self.l2) * self.rate
        return (feature, cut, value), value[node]

    def _walk(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.ones(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            inner = np.where(node < len(feature), node, 0)
            f = feature[inner]
            node = np.where(f >= 0, 2 * node + (x[rows, f] > cut[inner]), node)
        return value[node]

    def predict(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float32)
        score = np.full(len(x), self.base)
        for t in self.trees:
            score += self._walk(t, x)
        return 1 / (1 + np.exp(-score))
