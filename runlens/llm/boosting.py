"""Small gradient-boosted trees for binary labels, fitted and applied with numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Tree:
    """A full binary tree: a feature and a threshold per inner node, a value per leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def apply(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        inner = len(self.feature)
        while len(node) and node[0] < inner:
            right = x[np.arange(len(x)), self.feature[node]] > self.threshold[node]
            node = 2 * node + 1 + right
        return self.leaf[node - inner]


@dataclass
class Boosted:
    """Sum of trees; ``slope`` and ``shift`` turn the sum into a calibrated probability."""

    start: float
    trees: list[Tree]
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for tree in self.trees:
            total += tree.apply(x)
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def _grow(x: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, rate: float) -> Tree:
    """One tree for gradients ``g`` and curvatures ``h``, split where the gain is best."""
    inner = 2**depth - 1
    feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
    node = np.zeros(len(x), np.int64)
    binned = np.stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(cuts)], 1)
    score = lambda a, b: a * a / (b + 1.0)
    for at in range(inner):
        rows = np.flatnonzero(node == at)
        best = 1e-6
        for f, c in enumerate(cuts):
            if not len(c) or not len(rows):
                continue
            gs = np.bincount(binned[rows, f], g[rows], len(c) + 1).cumsum()
            hs = np.bincount(binned[rows, f], h[rows], len(c) + 1).cumsum()
            left, right = score(gs[:-1], hs[:-1]), score(gs[-1] - gs[:-1], hs[-1] - hs[:-1])
            gain = left + right - score(gs[-1], hs[-1])
            k = int(np.argmax(gain))
            if gain[k] > best:
                best, feature[at], threshold[at] = gain[k], f, c[k]
        node[rows] = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
    place = node - inner
    size = inner + 1
    leaf = -rate * np.bincount(place, g, size) / (np.bincount(place, h, size) + 1.0)
    return Tree(feature, threshold, leaf)


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2) -> Boosted:
    """Logistic boosting on binned features; four fifths fit, the rest calibrates."""
    held = np.arange(len(y)) % 5 == 4
    a, b = x[~held], y[~held].astype(float)
    cuts = []
    for f in range(x.shape[1]):
        values = np.unique(a[:, f])
        if len(values) > BINS:
            values = np.unique(np.quantile(values, np.linspace(0, 1, BINS)))
        cuts.append((values[:-1] + values[1:]) / 2)
    share = np.clip(b.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(float(np.log(share / (1 - share))), [])
    margin = np.full(len(b), model.start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(a, cuts, p - b, p * (1 - p), depth, rate)
        model.trees.append(tree)
        margin += tree.apply(a)
    _calibrate(model, x[held], y[held].astype(float))
    return model


def _calibrate(model: Boosted, x: np.ndarray, y: np.ndarray) -> None:
    """Slope and shift of the margins by Newton steps on the held-out rows."""
    if len(y) == 0 or y.min() == y.max():
        return
    m, theta = model.margin(x), np.array([1.0, 0.0])
    design = np.stack([m, np.ones_like(m)], 1)
    for _ in range(20):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.eye(2)
        theta -= np.linalg.solve(curve, design.T @ (p - y) + theta - [1.0, 0.0])
    model.slope, model.shift = float(theta[0]), float(theta[1])


def threshold(p: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest probability from which on the wanted share is positive; inf if none is."""
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    last = np.ones(len(y), bool)
    last[:-1] = p[order][:-1] != p[order][1:]
    good = np.flatnonzero((right >= precision) & last)
    return float(p[order][good[-1]]) if len(good) else float("inf")
