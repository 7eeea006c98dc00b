"""Gradient-boosted trees over binned features, fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth: node k's children are 2k + 1 and 2k + 2; rows go right where the feature
    is above the cut; `values` are the leaves'."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    values: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of each row."""
        out = np.full(len(x), self.base)
        flat, rows, width = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], x.shape[1]
        inner = self.feature.shape[1]
        assert width or not len(x)
        for feature, cut, values in zip(self.feature, self.cut, self.values, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                at = 2 * at + 1 + (flat[rows + feature[at]] > cut[at])
            out += values[at - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 32, penalty: float = 2.0, share: float = 0.7, seed: int = 0) -> Trees:
    """Trees for the logistic loss: each is grown level by level from histograms of gradients on a random `share` of the
    features, splits by the largest gain, and adds `rate` of its leaves' Newton steps.

    Features are cut at quantiles into `bins`.  No rows, or one class alone, give trees that say the prior."""
    n, m = x.shape
    p = (y.sum() + 1.0) / (n + 2.0)
    base, inner = float(np.log(p / (1 - p))), (1 << depth) - 1
    if not n or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    binned = np.column_stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)]).astype(np.int64)
    rng, score = np.random.default_rng(seed), np.full(n, base)
    features, borders, leaves = [], [], []
    for _ in range(trees):
        q = 1 / (1 + np.exp(-score))
        g, h = y - q, q * (1 - q)
        used = np.sort(rng.choice(m, max(1, int(share * m)), replace=False))
        feature, border, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            start, k = (1 << level) - 1, 1 << level
            best = np.full(k, 1e-6)
            where = (at - start) * bins
            for f in used.tolist():
                cell = where + binned[:, f]
                sg = np.bincount(cell, g, k * bins).reshape(k, bins).cumsum(axis=1)
                sh = np.bincount(cell, h, k * bins).reshape(k, bins).cumsum(axis=1)
                tg, th = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + penalty) + (tg - sg) ** 2 / (th - sh + penalty) - tg**2 / (th + penalty)
                gain[(sh < 1) | (th - sh < 1)] = 0
                gain = gain[:, : len(cuts[f])]
                if not gain.shape[1]:
                    continue
                b = gain.argmax(axis=1)
                more = gain[np.arange(k), b] > best
                best[more] = gain[np.arange(k), b][more]
                feature[start : start + k][more] = f
                border[start : start + k][more] = cuts[f][b[more]]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > border[at])
        leaf = at - inner
        values = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + penalty)
        score += values[leaf]
        features.append(feature)
        borders.append(border)
        leaves.append(values)
    return Trees(base, np.array(features), np.array(borders), np.array(leaves))
