"""Gradient-boosted trees of fixed depth for small feature tables."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees in level order: a row goes right where its feature is above the cut."""

    depth: int
    base: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - len(feature)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss over at most ``bins`` quantile cuts per feature."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(share / (1 - share)))
    inner = (1 << depth) - 1
    model = Trees(depth, base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.zeros(width)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                size = len(c) + 1
                cell = (at - first) * size + binned[:, f]
                gs = np.bincount(cell, g, width * size).reshape(width, size).cumsum(1)
                hs = np.bincount(cell, h, width * size).reshape(width, size).cumsum(1)
                gl, hl, ga, ha = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + l2) + (ga - gl) ** 2 / (ha - hl + l2) - ga**2 / (ha + l2)
                gain[(hl < 1e-3) | (ha - hl < 1e-3)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                for node in np.flatnonzero(value > best + 1e-9):
                    best[node] = value[node]
                    model.features[t, first + node], model.cuts[t, first + node] = f, c[top[node]]
            at = 2 * at + 1 + (x[np.arange(len(y)), model.features[t, at]] > model.cuts[t, at])
        leaf = at - inner
        total, weight = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        model.leaves[t] = -rate * total / (weight + l2)
        margin += model.leaves[t, leaf]
    return model
