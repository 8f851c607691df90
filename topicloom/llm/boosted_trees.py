"""Histogram gradient-boosted trees in numpy, for small dense feature tables.

Features are cut into at most ``BINS`` quantile bins. Trees grow level by level; each level sums the
gradients of all its nodes into histograms, one ``bincount`` per feature, and splits where the loss
falls most. A tree of depth d is a full binary tree in arrays: node i has the children 2i+1 and
2i+2, so all rows walk down together in d steps.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BINS = 64


class Forest(NamedTuple):
    depth: int
    base: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray  # go right if the value is greater
    value: np.ndarray  # (trees, 2**depth), by leaf


def train(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, ridge: float = 1.0, least: int = 8) -> Forest:
    """Fit the log-odds of y = 1. One class alone, or no rows, give a constant."""
    n, width = x.shape
    share = (y.sum() + 1.0) / (n + 2.0)
    base = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature, threshold = np.zeros((trees, inner), np.int32), np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    if n == 0 or y.min() == y.max():
        return Forest(depth, base, feature, threshold, value)
    cuts = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS, method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    raw = np.full(n, base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            wide, first = 1 << level, (1 << level) - 1
            best = np.zeros(wide)
            for f in range(width):
                if not len(cuts[f]):
                    continue
                at = node * BINS + binned[:, f]
                sums = [np.bincount(at, w, wide * BINS).reshape(wide, BINS) for w in (g, h, None)]
                left = [np.cumsum(s, axis=1)[:, :-1] for s in sums]
                total = [s.sum(axis=1)[:, None] for s in sums]
                right = [t - s for t, s in zip(total, left, strict=True)]
                gain = left[0] ** 2 / (left[1] + ridge) + right[0] ** 2 / (right[1] + ridge) - total[0] ** 2 / (total[1] + ridge)
                gain[(left[2] < least) | (right[2] < least)] = 0
                cut = gain[:, : len(cuts[f])].argmax(axis=1)
                top = gain[np.arange(wide), cut]
                better = np.flatnonzero(top > best + 1e-9)
                best[better] = top[better]
                feature[tree, first + better] = f
                threshold[tree, first + better] = cuts[f][cut[better]]
            go = x[np.arange(n), feature[tree, first + node]] > threshold[tree, first + node]
            node = 2 * node + go
        value[tree] = -rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + ridge)
        raw += value[tree][node]
    return Forest(depth, base, feature, threshold, value)


def predict(forest: Forest, x: np.ndarray) -> np.ndarray:
    """Probability of class 1 for every row."""
    raw, rows = np.full(len(x), forest.base), np.arange(len(x))
    for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value, strict=True):
        node = np.zeros(len(x), np.int64)
        for _ in range(forest.depth):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        raw += value[node - len(feature)]
    return 1 / (1 + np.exp(-raw))
