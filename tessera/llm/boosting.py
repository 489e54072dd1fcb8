"""Gradient-boosted trees for small, bounded training samples (logistic loss).

Trees are plain arrays, so a fitted model is a small closure that tasks evaluate on whole
batches. Splits are searched over at most ``BINS`` quantiles of each feature.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.ridge = rounds, depth, rate, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start, self.scale, self.shift = 0.0, 1.0, 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        bins = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1)  # bin <= i  <=>  value <= edge i
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(p / (1 - p)))
        f = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self._tree(bins, edges, y - p, p * (1 - p))
            self.trees.append(tree)
            f += self.rate * _leaf(tree, x, self.depth)
        return self

    def _tree(self, bins, edges, g, h):
        """A complete tree in heap order: feature (-1: none), threshold, leaf values."""
        inner = 2 ** self.depth - 1
        feature, cut = np.full(inner, -1), np.zeros(inner)
        node = np.zeros(len(g), int)
        for n in range(inner):
            rows = np.flatnonzero(node == n)
            best = 1e-6
            for j, e in enumerate(edges):
                if len(e) and len(rows) >= 10:
                    gs = np.cumsum(np.bincount(bins[rows, j], g[rows], len(e) + 1))
                    hs = np.cumsum(np.bincount(bins[rows, j], h[rows], len(e) + 1))
                    left, right = gs[:-1] ** 2 / (hs[:-1] + self.ridge), (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + self.ridge)
                    gain = left + right - gs[-1] ** 2 / (hs[-1] + self.ridge)
                    i = int(gain.argmax())
                    if gain[i] > best:
                        best, feature[n], cut[n] = gain[i], j, e[i]
            right = bins[rows, feature[n]] > np.searchsorted(edges[feature[n]], cut[n]) if feature[n] >= 0 else np.zeros(len(rows), bool)
            node[rows] = 2 * n + 1 + right
        leaf = node - inner
        size = 2 ** self.depth
        return feature, cut, np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + self.ridge)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.start + self.rate * sum((_leaf(t, x, self.depth) for t in self.trees), np.zeros(len(x)))

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Platt scaling on rows that the trees haven't seen."""
        m, a, b = self.margin(x), 1.0, 0.0
        t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
            w, r = np.maximum(p * (1 - p), 1e-6), p - t
            grad = np.array([(r * m).sum() + 1e-3 * (a - 1), r.sum()])
            hess = np.array([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-3]])
            step = np.linalg.solve(hess, grad)
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        self.scale, self.shift = (float(a), float(b)) if a > 0 else (1.0, 0.0)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.margin(x) + self.shift, -30, 30)))


def _leaf(tree, x: np.ndarray, depth: int) -> np.ndarray:
    feature, cut, value = tree
    node = np.zeros(len(x), int)
    rows = np.arange(len(x))
    for _ in range(depth):
        f = feature[node]
        node = 2 * node + 1 + ((f >= 0) & (x[rows, f] > cut[node]))
    return value[node - len(feature)]
