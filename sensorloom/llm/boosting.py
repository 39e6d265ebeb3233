"""Histogram gradient-boosted trees for a yes-no label, flattened into arrays.

Fitting takes a bounded table of numbers (a drawn sample); prediction walks all trees for
all rows at once, one level per step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """Trees side by side: node ``i`` of tree ``t`` is entry ``[t, i]``, children of ``i`` are
    ``2i + 1`` and ``2i + 2``. A leaf sends every row left into copies of itself."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    value: np.ndarray  # trees x leaves
    base: float
    depth: int

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of each row. A missing number (NaN) goes left."""
        n, trees = len(rows), len(self.feature)
        tree = np.arange(trees)
        at = np.arange(n)[:, None]
        node = np.zeros((n, trees), np.int32)
        for _ in range(self.depth):
            right = rows[at, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.value[tree, node - (2**self.depth - 1)].sum(axis=1)

    def probability(self, rows: np.ndarray, block: int = 4096) -> np.ndarray:
        rows = np.asarray(rows, np.float64)
        parts = [self.margins(rows[i : i + block]) for i in range(0, len(rows), block)]
        return 1 / (1 + np.exp(-np.concatenate(parts))) if parts else np.zeros(0)


def _edges(column: np.ndarray) -> np.ndarray:
    """Bounds between bins: half way between neighbouring quantiles."""
    column = column[np.isfinite(column)]
    if not len(column):
        return column
    values = np.unique(np.quantile(column, np.linspace(0, 1, BINS), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    smoothing: float = 1.0,
    least_weight: float = 2.0,
    weights: np.ndarray | None = None,
) -> Forest:
    """Boost ``trees`` trees of ``depth`` levels on the logistic loss.

    With one class only, or no rows, the forest answers that class's smoothed share.
    """
    weights = np.ones(len(labels)) if weights is None else weights
    rows = np.atleast_2d(np.asarray(rows, np.float64))
    labels = np.asarray(labels, np.float64)
    n, width = rows.shape
    share = ((weights * labels).sum() + 0.5) / (weights.sum() + 1)
    margin = np.full(n, np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, inner), np.int32)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    forest = Forest(feature, threshold, value, float(margin[0]) if n else 0.0, depth)
    if n == 0 or labels.min() == labels.max():
        return forest
    edges = [_edges(column) for column in rows.T]
    binned = np.stack(
        [np.searchsorted(e, np.nan_to_num(c, nan=-np.inf), side="left") for e, c in zip(edges, rows.T)], axis=1
    )
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = weights * (labels - p), weights * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            local = node - first
            best = np.zeros(count)
            for f in range(width):
                if not len(edges[f]):
                    continue
                key = local * BINS + binned[:, f]
                g = np.bincount(key, gradient, count * BINS).reshape(count, BINS).cumsum(axis=1)
                h = np.bincount(key, weight, count * BINS).reshape(count, BINS).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + smoothing) + (all_g - g) ** 2 / (all_h - h + smoothing)
                gain -= all_g**2 / (all_h + smoothing)
                gain[(h < least_weight) | (all_h - h < least_weight)] = 0
                gain = gain[:, : len(edges[f])]
                place = gain.argmax(axis=1)
                top = gain[np.arange(count), place]
                better = top > best + 1e-9
                best[better] = top[better]
                feature[t, first : first + count][better] = f
                threshold[t, first : first + count][better] = edges[f][place[better]]
            right = rows[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        leaf = node - inner
        g = np.bincount(leaf, gradient, leaves)
        h = np.bincount(leaf, weight, leaves)
        value[t] = rate * g / (h + smoothing)
        margin += value[t][leaf]
    return forest
