"""Gradient-boosted trees with monotonic constraints, as flat numpy node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees.  A row goes left if its feature is at most the threshold; a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row: all trees at once, one level a step."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.bias + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def train(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = 60, depth: int = 3, rate: float = 0.2,
          bins: int = 64, least_weight: float = 2.0, ridge: float = 1.0, weight: np.ndarray | None = None) -> Forest:
    """Boost logistic loss on rows ``x`` with labels ``y`` (0, 1), each counted ``weight`` times (else once).

    ``signs`` has for each feature 1 (the score never falls as it grows), -1
    (never rises) or 0.  A split on a constrained feature must order its two
    sides' values, and bounds at their midpoint hold for all below, so that the
    sum over the trees is monotonic as well.
    """
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(width)], axis=1) if n else np.zeros((0, width), int)
    weight = np.ones(n) if weight is None else weight
    share = min(max(float(np.average(y, weights=weight)) if n else 0.5, 1e-3), 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    margin = np.full(n, bias)
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots = []

    def leaf(value: float) -> int:
        k = len(nodes["value"])
        for name, v in (("feature", 0), ("threshold", np.inf), ("left", k), ("right", k), ("value", value * rate)):
            nodes[name].append(v)
        return k

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = grad[rows], hess[rows]
        total_g, total_h = g.sum(), h.sum()
        best = (1e-6, -1, -1, 0.0, 0.0)
        if level < depth:
            for f in range(width):
                if not len(edges[f]):
                    continue
                size = len(edges[f]) + 1
                lg = np.bincount(binned[rows, f], g, size).cumsum()[:-1]
                lh = np.bincount(binned[rows, f], h, size).cumsum()[:-1]
                rg, rh = total_g - lg, total_h - lh
                lv, rv = (np.clip(-a / (b + ridge), low, high) for a, b in ((lg, lh), (rg, rh)))
                whole = np.clip(-total_g / (total_h + ridge), low, high)
                # fall of the loss with the values as clipped
                gain = sum(-(a * v + (b + ridge) * v * v / 2) for a, b, v in ((lg, lh, lv), (rg, rh, rv)))
                gain = gain + total_g * whole + (total_h + ridge) * whole ** 2 / 2
                gain[(lh < least_weight) | (rh < least_weight) | (signs[f] * (rv - lv) < 0)] = -np.inf
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], f, k, lv[k], rv[k])
        _, f, k, lv, rv = best
        if f < 0:
            return leaf(float(np.clip(-total_g / (total_h + ridge), low, high)))
        me = leaf(0.0)
        mid = (lv + rv) / 2
        bounds = {1: ((low, mid), (mid, high)), -1: ((mid, high), (low, mid)), 0: ((low, high),) * 2}[signs[f]]
        goes = binned[rows, f] <= k
        nodes["feature"][me], nodes["threshold"][me] = f, float(edges[f][k])
        nodes["left"][me] = grow(rows[goes], level + 1, *bounds[0])
        nodes["right"][me] = grow(rows[~goes], level + 1, *bounds[1])
        return me

    for _ in range(trees if n else 0):
        p = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
        grad, hess = weight * (p - y), weight * p * (1 - p)
        first = len(nodes["value"])
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
        one = Forest(*(np.array(v) for v in ([first], *(nodes[k] for k in ("feature", "threshold", "left", "right", "value")))),
                     0.0, depth)
        margin = margin + one.margin(x)
    if not roots:
        roots.append(leaf(0.0))
    kinds = {"feature": np.int64, "threshold": float, "left": np.int64, "right": np.int64, "value": float}
    return Forest(np.array(roots), *(np.array(nodes[k], kinds[k]) for k in kinds), bias, depth)
