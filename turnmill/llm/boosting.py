"""Gradient-boosted trees for a yes/no label, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosting:
    trees: int = 80
    depth: int = 4
    rate: float = 0.15
    bins: int = 16
    least: float = 2.0  # second-order weight a leaf must have
    l2: float = 1.0


class Trees:
    """Complete binary trees of one depth: split `feature`, `cut` and the leaves' values."""

    def __init__(self, x: np.ndarray, y: np.ndarray, how: Boosting) -> None:
        self.how = how
        cuts = np.linspace(0, 1, how.bins + 1)[1:-1]
        self.edges = [np.unique(np.quantile(x[:, f], cuts)) for f in range(x.shape[1])]
        binned = self._binned(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.base = float(np.log(rate / (1 - rate)))
        self.feature, self.cut, self.value = [], [], []
        score = np.full(len(y), self.base)
        for _ in range(how.trees if len(y) else 0):
            p = 1 / (1 + np.exp(-score))
            leaf, value = self._grow(binned, p - y, p * (1 - p))
            score += value[leaf]

    def _binned(self, x: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)]
        return np.stack(columns, axis=1).astype(np.int64)

    def _grow(self, binned, slope, curve) -> tuple[np.ndarray, np.ndarray]:
        how, (n, features) = self.how, binned.shape
        inner = (1 << how.depth) - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, how.bins, np.int64)
        node = np.zeros(n, np.int64)  # place inside its level
        column = np.arange(features) * how.bins
        for level in range(how.depth):
            wide = 1 << level
            at = (node[:, None] * features * how.bins + column + binned).ravel()
            shape = (wide, features, how.bins)
            count = wide * features * how.bins
            g = np.bincount(at, np.repeat(slope, features), count).reshape(shape).cumsum(axis=2)
            h = np.bincount(at, np.repeat(curve, features), count).reshape(shape).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + how.l2) + (all_g - g) ** 2 / (all_h - h + how.l2)
            gain -= all_g**2 / (all_h + how.l2)
            gain[(h < how.least) | (all_h - h < how.least)] = 0
            best = gain.reshape(wide, -1).argmax(axis=1)
            useful = gain.reshape(wide, -1).max(axis=1) > 1e-9
            first = wide - 1
            feature[first : first + wide] = best // how.bins
            # Where no split helps, everything goes left.
            cut[first : first + wide] = np.where(useful, best % how.bins, how.bins)
            here = first + node
            node = 2 * node + (binned[np.arange(n), feature[here]] > cut[here])
        leaves = 1 << how.depth
        g, h = np.bincount(node, slope, leaves), np.bincount(node, curve, leaves)
        value = -how.rate * g / (h + how.l2)
        self.feature.append(feature)
        self.cut.append(cut)
        self.value.append(value)
        return node, value

    def probability(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self._binned(x), np.arange(len(x))
        score = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for level in range(self.how.depth):
                here = (1 << level) - 1 + node
                node = 2 * node + (binned[rows, feature[here]] > cut[here])
            score += value[node]
        return 1 / (1 + np.exp(-score))
