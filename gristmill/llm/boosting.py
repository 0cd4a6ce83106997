"""Small gradient-boosted trees for two classes, with calibrated scores."""

from __future__ import annotations

import numpy as np


class Trees:
    """Depth-limited regression trees on the logistic loss, grown greedily by exact splits."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0, least: int = 8):
        self.rounds, self.depth, self.rate, self.ridge, self.least = rounds, depth, rate, ridge, least
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(share / (1 - share))), []
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(x, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            margin += self.rate * _walk(tree, x)
        return self

    def _grow(self, x, g, h, rows, depth):
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best = (1e-6, None, None)
        for f in range(x.shape[1]) if depth and len(rows) >= 2 * self.least else ():
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, left_g, left_h = x[order, f], np.cumsum(g[order])[:-1], np.cumsum(h[order])[:-1]
            gain = left_g**2 / (left_h + self.ridge) + (total_g - left_g) ** 2 / (total_h - left_h + self.ridge) - total_g**2 / (total_h + self.ridge)
            size = np.arange(1, len(order))
            gain[(v[1:] == v[:-1]) | (size < self.least) | (len(order) - size < self.least)] = -1
            if len(gain) and gain.max() > best[0]:
                k = int(gain.argmax())
                best = (float(gain[k]), f, (v[k] + v[k + 1]) / 2)
        if best[1] is None:
            return float(total_g / (total_h + self.ridge))
        _, f, at = best
        low = x[rows, f] <= at
        return f, float(at), self._grow(x, g, h, rows[low], depth - 1), self._grow(x, g, h, rows[~low], depth - 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((_walk(t, x) for t in self.trees), np.zeros(len(x)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def _walk(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    f, at, low, high = tree
    return np.where(x[:, f] <= at, _walk(low, x), _walk(high, x))


def threshold(scores: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The smallest score from which on at least that share of the rows are of class 1; above all scores if there is none."""
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    ok = np.nonzero(right >= precision)[0]
    return float(scores[order][ok[-1]]) if len(ok) else float(scores.max()) + 1e-9
