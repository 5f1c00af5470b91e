"""Gradient-boosted trees for two classes and isotonic calibration, in numpy, for bounded samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Isotonic:
    """A non-decreasing step function fitted by pooling adjacent violators; linear between the pools' means."""

    x: np.ndarray
    y: np.ndarray

    @classmethod
    def fit(cls, score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> Isotonic:
        values, inverse = np.unique(score, return_inverse=True)
        w = np.bincount(inverse, weights=weight, minlength=len(values))
        y = np.bincount(inverse, weights=weight * label, minlength=len(values)) / w
        pools: list[list[float]] = []  # mean, weight, weighted sum of scores
        for v, m, k in zip(values, y, w):
            pools.append([m, k, v * k])
            while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
                m2, k2, s2 = pools.pop()
                m1, k1, s1 = pools.pop()
                pools.append([(m1 * k1 + m2 * k2) / (k1 + k2), k1 + k2, s1 + s2])
        return cls(np.array([s / k for _, k, s in pools]), np.array([m for m, _, _ in pools]))

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.x, self.y)


@dataclass
class Trees:
    """Trees of fixed depth over binned features, stored as heaps."""

    edges: list[np.ndarray]
    depth: int
    start: float
    features: list[np.ndarray] = field(default_factory=list)
    splits: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0) -> Trees:
        edges = [np.unique(np.quantile(np.unique(x[:, f]), np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
        p = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4)
        model = cls(edges, depth, float(np.log(p / (1 - p))))
        binned = model._binned(x)
        raw = np.full(len(y), model.start)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = weight * (y - p), weight * p * (1 - p)
            node = np.zeros(len(y), dtype=np.int64)
            feature, split = np.zeros(2**depth - 1, dtype=np.int64), np.full(2**depth - 1, bins, dtype=np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for f in range(x.shape[1]):
                    cell = (node - first) * bins + binned[:, f]
                    g = np.bincount(cell, weights=grad, minlength=count * bins).reshape(count, bins)
                    h = np.bincount(cell, weights=hess, minlength=count * bins).reshape(count, bins)
                    gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                    gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                    gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                    k = gain.argmax(1)
                    top = gain[np.arange(count), k]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + count][better], split[first : first + count][better] = f, k[better]
                node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > split[node])
            leaf = node - (2**depth - 1)
            g, h = np.bincount(leaf, weights=grad, minlength=2**depth), np.bincount(leaf, weights=hess, minlength=2**depth)
            model.features.append(feature)
            model.splits.append(split)
            model.leaves.append(rate * g / (h + l2))
            raw += model.leaves[-1][leaf]
        return model

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]) if len(x) else np.zeros(x.shape, dtype=np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Log-odds."""
        binned, rows = self._binned(x), np.arange(len(x))
        raw = np.full(len(x), self.start)
        for feature, split, leaf in zip(self.features, self.splits, self.leaves):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > split[node])
            raw += leaf[node - (2**self.depth - 1)]
        return raw
