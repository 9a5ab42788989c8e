"""Histogram gradient-boosted trees for two classes, in numpy.

Training sorts each measure into at most ``bins`` bins once; a level of a tree needs one
count per (node, measure, bin). A trained model is five flat arrays, and rows go through all
trees by array indexing, one step per level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Full binary trees of one depth: node i of a tree has children 2i + 1 and 2i + 2."""

    measure: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        total = np.full(len(rows), self.base)
        if not len(rows):
            return total
        each = np.arange(len(rows))
        for measure, threshold, value in zip(self.measure, self.threshold, self.value, strict=True):
            node = np.zeros(len(rows), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (rows[each, measure[node]] > threshold[node])
            total += value[node - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-total))


def train(
    rows: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.1, bins: int = 64, ridge: float = 5.0, least_rows: int = 20
) -> Trees:
    """Labels 0 and 1. Without both of them, the model is their smoothed share."""
    inner, leaves, width = 2**depth - 1, 2**depth, rows.shape[1]
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Trees(np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), float(np.log(share / (1 - share))), depth)
    if len(labels) < 2 * least_rows or labels.min() == labels.max():
        return model
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], rows[:, j]) for j in range(width)], axis=1)  # bin b: above edge b - 1, not above edge b
    total = np.full(len(rows), model.base)
    measures, thresholds, values = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        slope, curve = chance - labels, chance * (1 - chance)
        node = np.zeros(len(rows), dtype=np.int64)
        measure, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = ((node - first)[:, None] * width + np.arange(width)) * bins + binned
            shape = (count, width, bins)
            sums = [np.bincount(place.ravel(), weights=np.repeat(w, width), minlength=count * width * bins).reshape(shape).cumsum(axis=2) for w in (slope, curve, np.ones(len(rows)))]
            (g, h, n), (gt, ht, nt) = sums, (s[:, :, -1:] for s in sums)
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[(n < least_rows) | (nt - n < least_rows)] = 0
            for j in range(width):
                gain[:, j, len(edges[j]) :] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for i in np.flatnonzero(gain.reshape(count, -1).max(axis=1) > 1e-9):
                j, b = divmod(int(best[i]), bins)
                measure[first + i], threshold[first + i] = j, edges[j][b]
            node = 2 * node + 1 + (rows[np.arange(len(rows)), measure[node]] > threshold[node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, leaves), np.bincount(leaf, curve, leaves)
        value = -rate * g / (h + ridge)
        total += value[leaf]
        measures.append(measure)
        thresholds.append(threshold)
        values.append(value)
    model.measure, model.threshold, model.value = np.array(measures), np.array(thresholds), np.array(values)
    return model
