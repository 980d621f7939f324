"""Small gradient-boosted trees for bounded training samples, scored in
batches on the executors, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete trees of one depth: split feature and value of each inner node
    by level, and leaf values; a row goes right where it exceeds the value."""

    feature: np.ndarray
    value: np.ndarray
    leaf: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not len(x) or not len(self.leaf):
            return out
        trees, inner = self.feature.shape
        row, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        at = np.zeros((len(x), trees), np.int64)
        while at[0, 0] < inner:
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.value[tree, at])
        return out + self.leaf[tree, at - inner].sum(1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def _split_values(column: np.ndarray, bins: int) -> np.ndarray:
    """Values between which a feature may be split."""
    seen = np.unique(column)
    if len(seen) > bins:
        seen = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)))
    return (seen[:-1] + seen[1:]) / 2


def fit_boosted(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15,
                bins: int = 48, least: float = 0.3, l2: float = 1.0) -> Boosted:
    """Logistic boosting with histogram splits. ``least`` is the smallest
    hessian sum of a child. One class, or no rows: the class's log-odds."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    mean = float(np.clip(y.mean() if len(y) else 0.0, 1e-4, 1 - 1e-4))
    base = float(np.log(mean / (1 - mean)))
    inner = 2 ** depth - 1
    if len(y) == 0 or y.min() == y.max():
        return Boosted(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    n, width = x.shape
    cuts = [_split_values(x[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], 1)
    slots = max(len(c) for c in cuts) + 1
    open_cut = np.array([[b < len(c) for b in range(slots)] for c in cuts])
    flat = binned + np.arange(width) * slots
    margin = np.full(n, base)
    features, values, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        feature, value, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            key = ((node - first)[:, None] * (width * slots) + flat).ravel()
            shape = (count, width, slots)
            sums = [np.cumsum(np.bincount(key, np.repeat(v, width), count * width * slots).reshape(shape), 2)
                    for v in (g, h)]
            gl, hl = sums
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gr, hr = gt - gl, ht - hl
            gain = gl ** 2 / (hl + l2) + gr ** 2 / (hr + l2) - gt ** 2 / (ht + l2)
            gain = np.where((hl >= least) & (hr >= least) & open_cut[None], gain, -1.0).reshape(count, -1)
            best = gain.argmax(1)
            good = gain[np.arange(count), best] > 1e-6
            f, b = best // slots, best % slots
            for k in np.flatnonzero(good):
                feature[first + k], value[first + k] = f[k], cuts[f[k]][b[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > value[node])
        at = node - inner
        leaf = rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + l2)
        margin += leaf[at]
        features.append(feature)
        values.append(value)
        leaves.append(leaf)
    return Boosted(np.array(features), np.array(values), np.array(leaves), base)


@dataclass
class Isotonic:
    """Monotone map from margins to probabilities, linear between blocks."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.x, self.y)


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; each block's mean stands at its mean margin,
    pulled in by half an observation at the ends so that scores stay inside
    (0, 1). No rows: the logistic function's own values."""
    if not len(margin):
        grid = np.linspace(-6, 6, 25)
        return Isotonic(grid, 1 / (1 + np.exp(-grid)))
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # weight, sum of y, sum of margin
    for m, v in zip(margin[order], np.asarray(y, float)[order]):
        blocks.append([1.0, v, m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, s, t = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w, blocks[-1][1] + s, blocks[-1][2] + t]
    w, s, t = np.array(blocks).T
    return Isotonic(t / w, np.clip(s / w, 0.5 / (w + 1), 1 - 0.5 / (w + 1)) if len(w) > 1 else s / w)
