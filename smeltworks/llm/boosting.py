"""Small gradient-boosted trees on numpy, for a bounded training sample on the driver."""

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosted:
    """Complete binary trees of one depth. ``feature`` and ``cut`` per inner node (value <= cut goes left), ``leaf`` values."""

    bias: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        out, depth = np.full(len(x), self.bias), int(np.log2(self.leaf.shape[1]))
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Logistic loss, second-order leaf values, cuts at quantiles."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    score, inner = np.full(len(y), bias), 2**depth - 1
    features, limits, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for node in range(inner):
            rows = np.flatnonzero(at == node)
            best = 1e-6
            for j, c in enumerate(cuts):
                if not len(c) or not len(rows):
                    continue
                gl = np.cumsum(np.bincount(binned[rows, j], g[rows], len(c) + 1))
                hl = np.cumsum(np.bincount(binned[rows, j], h[rows], len(c) + 1))
                gain = gl**2 / (hl + ridge) + (gl[-1] - gl) ** 2 / (hl[-1] - hl + ridge) - gl[-1] ** 2 / (hl[-1] + ridge)
                k = int(gain[:-1].argmax())
                if gain[k] > best:
                    best, feature[node], limit[node] = gain[k], j, c[k]
            if len(rows):
                at[rows] = 2 * node + 1 + (x[rows, feature[node]] > limit[node])
        leaf = np.zeros(inner + 1)
        np.add.at(leaf, at - inner, g)
        weight = np.zeros(inner + 1)
        np.add.at(weight, at - inner, h)
        leaf = rate * leaf / (weight + ridge)
        score += leaf[at - inner]
        features.append(feature), limits.append(limit), leaves.append(leaf)
    return Boosted(bias, np.array(features), np.array(limits), np.array(leaves))


def calibrate(score: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of a logistic curve from scores to probabilities, targets smoothed against small samples."""
    up, down = (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2)
    target, x = np.where(y > 0, up, down), np.stack([score, np.ones(len(score))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w + np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * (w - np.array([1.0, 0.0])))
    return float(w[0]), float(w[1])
