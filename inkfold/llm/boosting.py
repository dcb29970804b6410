"""Gradient-boosted trees for a yes-or-no label, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Forest:
    """Trees of one depth as arrays: node i has children 2i + 1 and 2i + 2; a row goes right if its bin is over the cut."""

    edges: list[np.ndarray]
    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    depth: int

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)]).astype(np.uint8)

    def margins(self, x: np.ndarray) -> np.ndarray:
        binned, rows, total = self.bins(x), np.arange(len(x)), np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
            total += leaf[at - (2**self.depth - 1)]
        return total


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, damping: float = 1.0) -> Forest:
    """Trees fitted one after the other to the slope of the logistic loss; every split is the best over all features and bins."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    forest = Forest(edges, float(np.log(share / (1 - share))), np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth - 1), np.int64), np.zeros((0, 2**depth)), depth)
    binned, margin = forest.bins(x), np.full(len(x), forest.base)
    flat = binned.astype(np.int64) + np.arange(x.shape[1]) * BINS
    features, cuts, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = p - y, p * (1 - p)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, BINS, np.int64)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            cell = ((at - first)[:, None] * (x.shape[1] * BINS) + flat).ravel()
            size = n * x.shape[1] * BINS
            g = np.bincount(cell, np.repeat(slope, x.shape[1]), size).reshape(n, x.shape[1], BINS).cumsum(2)
            h = np.bincount(cell, np.repeat(bend, x.shape[1]), size).reshape(n, x.shape[1], BINS).cumsum(2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g * g / (h + damping) + (all_g - g) ** 2 / (all_h - h + damping) - all_g * all_g / (all_h + damping)
            best = gain.reshape(n, -1).argmax(1)
            good = gain.reshape(n, -1)[np.arange(n), best] > 1e-9
            feature[first : first + n] = best // BINS
            cut[first : first + n] = np.where(good, best % BINS, BINS)
            at = 2 * at + 1 + (binned[np.arange(len(x)), feature[at]] > cut[at])
        last = 2**depth - 1
        leaf = -rate * np.bincount(at - last, slope, 2**depth) / (np.bincount(at - last, bend, 2**depth) + damping)
        margin += leaf[at - last]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    forest.feature, forest.cut, forest.leaf = np.array(features), np.array(cuts), np.array(leaves)
    return forest
