"""Gradient boosted trees for binary labels: histogram splits, logistic loss, numpy only."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Trees of fixed depth stored as heaps: node i has children 2i+1 and 2i+2."""

    rounds: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 24
    l2: float = 1.0
    bias: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)
    scale: float = 1.0
    shift: float = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(mean / (1 - mean)))
        score = np.full(len(y), self.bias)
        inner, width = 2**self.depth - 1, self.bins + 1
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            feat, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
            node = np.zeros(len(y), np.int64)
            for k in range(inner):
                rows = np.flatnonzero(node == k)
                best = (1e-6, None, None)
                if len(rows) >= 8:
                    gr, hr = g[rows], h[rows]
                    tot_g, tot_h = gr.sum(), hr.sum()
                    base = tot_g**2 / (tot_h + self.l2)
                    for j, e in enumerate(edges):
                        if not len(e):
                            continue
                        b = binned[rows, j]
                        lg = np.cumsum(np.bincount(b, gr, width))[: len(e)]
                        lh = np.cumsum(np.bincount(b, hr, width))[: len(e)]
                        gain = lg**2 / (lh + self.l2) + (tot_g - lg) ** 2 / (tot_h - lh + self.l2) - base
                        m = int(gain.argmax())
                        if gain[m] > best[0]:
                            best = (gain[m], j, e[m])
                if best[1] is not None:
                    feat[k], cut[k] = best[1], best[2]
                node[rows] = 2 * k + 1 + (x[rows, feat[k]] > cut[k])
            leaf = node - inner
            value = -np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + self.l2) * self.rate
            score += value[leaf]
            self.features.append(feat)
            self.cuts.append(cut)
            self.leaves.append(value)
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        inner = 2**self.depth - 1
        at = np.arange(len(x))
        for feat, cut, value in zip(self.features, self.cuts, self.leaves, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[at, feat[node]] > cut[node])
            out += value[node - inner]
        return out

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Platt scaling on rows kept from training, by a few Newton steps."""
        m = self.margin(x)
        a, b = 1.0, 0.0
        for _ in range(25):
            p = 1 / (1 + np.exp(-(a * m + b)))
            w = p * (1 - p) + 1e-6
            ga, gb = ((p - y) * m).sum() + 1e-2 * (a - 1), (p - y).sum()
            haa, hab, hbb = (w * m * m).sum() + 1e-2, (w * m).sum(), w.sum() + 1e-2
            det = haa * hbb - hab * hab
            a, b = a - (hbb * ga - hab * gb) / det, b - (haa * gb - hab * ga) / det
        self.scale, self.shift = float(a), float(b)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.margin(x) + self.shift)))
