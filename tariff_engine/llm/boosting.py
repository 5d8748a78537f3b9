"""Gradient-boosted trees for two classes, in numpy: histogram splits, logistic loss, Newton leaves."""

from __future__ import annotations

import numpy as np

BINS = 32


class BoostedTrees:
    """Trees of fixed depth, stored as arrays of (feature, threshold) per inner node and a value per leaf."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, smooth: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.smooth = trees, depth, rate, smooth
        self.base = 0.0
        self.nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """``x`` (rows, features), ``y`` 0 or 1. With one class only, the model is its smoothed rate."""
        rate = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(rate / (1 - rate)))
        self.nodes = []
        if len(np.unique(y)) < 2:
            return self
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
        margin = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            margin += self._grow(binned, cuts, p - y, p * (1 - p), x)
        return self

    def _grow(self, binned: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, x: np.ndarray) -> np.ndarray:
        inner = 2**self.depth - 1
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(len(g), dtype=np.int64)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = (1e-6, 0, np.inf)
            if len(rows) >= 2:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                whole = total_g**2 / (total_h + self.smooth)
                for f, cut in enumerate(cuts):
                    if not len(cut):
                        continue
                    left_g = np.cumsum(np.bincount(binned[rows, f], g[rows], minlength=len(cut) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(binned[rows, f], h[rows], minlength=len(cut) + 1))[:-1]
                    gain = left_g**2 / (left_h + self.smooth) - whole
                    gain += (total_g - left_g) ** 2 / (total_h - left_h + self.smooth)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, float(cut[k]))
            feature[node], threshold[node] = best[1], best[2]
            at[rows] = 2 * node + 1 + (x[rows, best[1]] > best[2])
        leaf = at - inner
        values = -self.rate * np.bincount(leaf, g, minlength=inner + 1) / (np.bincount(leaf, h, minlength=inner + 1) + self.smooth)
        self.nodes.append((feature, threshold, values))
        return values[leaf]

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, values in self.nodes:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            margin += values[at - len(feature)]
        return 1 / (1 + np.exp(-margin))
