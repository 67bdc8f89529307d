"""Gradient-boosted trees with softmax loss over small integer features (numpy only)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    classes: int
    base: np.ndarray
    rate: float
    #: Per round and class: arrays (feature, threshold, left, right, value); feature -1 marks a leaf.
    rounds: list[list[tuple]] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(x), 1))
        rows = np.arange(len(x))
        for trees in self.rounds:
            for c, (feature, threshold, left, right, value) in enumerate(trees):
                at = np.zeros(len(x), np.int64)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go = x[rows, np.maximum(f, 0)] <= threshold[at]
                    at = np.where(inner, np.where(go, left[at], right[at]), at)
                out[:, c] += self.rate * value[at]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        s = self.scores(x)
        e = np.exp(s - s.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)


def _grow(x, g, h, depth: int, least: float, ridge: float):
    """One regression tree on gradients and curvatures, split by exact gain at the values of small integer features."""
    feature, threshold, left, right, value = [], [], [], [], []

    def node(rows, level):
        at = len(feature)
        for a in (feature, threshold, left, right):
            a.append(-1)
        gs, hs = g[rows].sum(), h[rows].sum()
        value.append(-gs / (hs + ridge))
        best = (1e-9, None, None)
        if level < depth and len(rows) > 1:
            for f in range(x.shape[1]):
                v = x[rows, f]
                lo, hi = int(v.min()), int(v.max())
                if lo == hi:
                    continue
                gb, hb = (np.cumsum(np.bincount(v - lo, weights=w[rows])) for w in (g, h))
                gl, hl = gb[:-1], hb[:-1]
                gain = gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge)
                gain[(hl < least) | (hs - hl < least)] = 0
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, lo + k)
        if best[1] is not None:
            _, f, t = best
            go = x[rows, f] <= t
            feature[at], threshold[at] = f, t
            left[at] = node(rows[go], level + 1)
            right[at] = node(rows[~go], level + 1)
        return at

    node(np.arange(len(x)), 0)
    return tuple(np.array(a, np.int64) for a in (feature, threshold, left, right)) + (np.array(value),)


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, rounds: int = 30, depth: int = 4, rate: float = 0.3, least: float = 1e-3, ridge: float = 1.0) -> Trees:
    """Fit to integer features ``x``, class numbers ``y`` and row weights (counts of equal rows)."""
    share = np.bincount(y, weights=weight, minlength=classes) + 1
    model = Trees(classes, np.log(share / share.sum()), rate)
    onehot = np.eye(classes)[y]
    score = np.tile(model.base, (len(x), 1))
    for _ in range(rounds):
        e = np.exp(score - score.max(1, keepdims=True))
        p = e / e.sum(1, keepdims=True)
        trees = []
        for c in range(classes):
            t = _grow(x, (p[:, c] - onehot[:, c]) * weight, np.maximum(p[:, c] * (1 - p[:, c]), 1e-6) * weight, depth, least, ridge)
            one = Trees(1, np.zeros(1), rate, [[t]])
            score[:, c] += one.scores(x)[:, 0]
            trees.append(t)
        model.rounds.append(trees)
    return model
