"""Gradient-boosted trees for two classes, and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Logistic loss, trees of equal depth grown on binned features, shrunken leaves."""

    trees: int = 60
    depth: int = 3
    rate: float = 0.15
    bins: int = 48
    ridge: float = 1.0
    least: float = 1.0
    prior: float = 0.0
    features: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))
    cuts: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    leaves: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))

    def _edges(self, column: np.ndarray) -> np.ndarray:
        distinct = np.unique(column)
        if len(distinct) > self.bins:
            distinct = np.unique(np.concatenate([np.quantile(column, np.linspace(0, 1, self.bins // 2)), np.quantile(distinct, np.linspace(0, 1, self.bins // 2))]))
        return (distinct[1:] + distinct[:-1]) / 2

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        rows, width = x.shape
        share = float(np.clip(y.mean() if rows else 0.0, 1e-4, 1 - 1e-4))
        self.prior = float(np.log(share / (1 - share)))
        inner, outer = 2**self.depth - 1, 2**self.depth
        features, cuts, leaves = [], [], []
        if rows and 0 < y.sum() < rows:
            edges = [self._edges(x[:, f]) for f in range(width)]
            slots = max(len(e) for e in edges) + 1
            binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(width)], axis=1)
            raw = np.full(rows, self.prior)
            for _ in range(self.trees):
                p = 1 / (1 + np.exp(-raw))
                g, h = p - y, np.maximum(p * (1 - p), 1e-9)
                feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(rows, np.int64)
                for level in range(self.depth):
                    first, count = 2**level - 1, 2**level
                    local = node - first
                    best = self._splits(binned, local, g, h, count, width, slots)
                    for k, (f, b) in enumerate(best):
                        if f >= 0:
                            feature[first + k], cut[first + k] = f, edges[f][b]
                    node = 2 * node + 1 + (x[np.arange(rows), feature[node]] > cut[node])
                leaf = node - inner
                value = -self.rate * np.bincount(leaf, g, outer) / (np.bincount(leaf, h, outer) + self.ridge)
                raw += value[leaf]
                features.append(feature), cuts.append(cut), leaves.append(value)
        self.features = np.array(features, np.int64).reshape(-1, inner)
        self.cuts, self.leaves = np.array(cuts).reshape(-1, inner), np.array(leaves).reshape(-1, outer)
        return self

    def _splits(self, binned, local, g, h, count, width, slots) -> list[tuple[int, int]]:
        """The best (feature, edge) of each node, or (-1, 0)."""
        best, gains = [(-1, 0)] * count, np.full(count, 1e-6)
        for f in range(width):
            at = local * slots + binned[:, f]
            gs = np.bincount(at, g, count * slots).reshape(count, slots)
            hs = np.bincount(at, h, count * slots).reshape(count, slots)
            gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
            gt, ht = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
            gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
            gain[(hl < self.least * 0.05) | (ht - hl < self.least * 0.05)] = -1
            for k in range(count):
                b = int(gain[k].argmax()) if gain.shape[1] else 0
                if gain.shape[1] and gain[k, b] > gains[k]:
                    gains[k], best[k] = gain[k, b], (f, b)
        return best

    def raw(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.prior)
        inner = 2**self.depth - 1
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


@dataclass
class Isotonic:
    """A rising map from raw scores to probabilities: pooled adjacent violators, joined by lines."""

    at: np.ndarray = field(default_factory=lambda: np.zeros(1))
    to: np.ndarray = field(default_factory=lambda: np.full(1, 0.5))

    def fit(self, raw: np.ndarray, y: np.ndarray, smoothing: float = 0.5) -> Isotonic:
        """Each pool's probability is (positives + smoothing * prior share * 2) / (size + 2 * smoothing)."""
        if not len(raw):
            return self
        order = np.argsort(raw, kind="stable")
        share = float(y.mean())
        pools: list[list[float]] = []  # positives, size, sum of raw scores
        for r, v in zip(raw[order].tolist(), y[order].tolist(), strict=True):
            pools.append([v, 1.0, r])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.at = np.array([p[2] / p[1] for p in pools])
        self.to = np.maximum.accumulate([(p[0] + 2 * smoothing * share) / (p[1] + 2 * smoothing) for p in pools])
        return self

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.at, self.to)
