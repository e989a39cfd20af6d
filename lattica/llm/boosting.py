"""Gradient-boosted trees for two classes, on arrays; small, without dependencies."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Each tree is complete, of one depth: per inner node a feature and a limit, per leaf a value."""

    start: float
    features: np.ndarray  # trees x inner nodes
    limits: np.ndarray
    leaves: np.ndarray  # trees x leaves

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1]))
        for feature, limit, leaf in zip(self.features, self.limits, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += leaf[at - (leaf.shape[0] - 1)]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 5, rate: float = 0.3, held: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss over quantile bins; ``held`` is the ridge on leaf values."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    total = np.full(len(y), start)
    inner, ends = 2**depth - 1, 2**depth
    features, limits, leaves = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, ends))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first = 2**level - 1
            count = 2**level
            best = np.full(count, 1e-9)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                cell = (at - first) * (BINS + 1) + binned[:, f]
                g = np.bincount(cell, slope, count * (BINS + 1)).reshape(count, -1).cumsum(1)
                h = np.bincount(cell, bend, count * (BINS + 1)).reshape(count, -1).cumsum(1)
                rest_g, rest_h = g[:, -1:] - g, h[:, -1:] - h
                gain = g**2 / (h + held) + rest_g**2 / (rest_h + held) - g[:, -1:] ** 2 / (h[:, -1:] + held)
                gain = gain[:, : len(c)]
                top = gain.argmax(1)
                better = gain[np.arange(count), top] > best
                best = np.where(better, gain[np.arange(count), top], best)
                features[t, first : first + count][better] = f
                limits[t, first : first + count][better] = c[top[better]]
            at = 2 * at + 1 + (x[np.arange(len(x)), features[t][at]] > limits[t][at])
        leaf = at - inner
        leaves[t] = rate * np.bincount(leaf, slope, ends) / (np.bincount(leaf, bend, ends) + held)
        total += leaves[t][leaf]
    return Trees(start, features, limits, leaves)
