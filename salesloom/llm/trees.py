"""Small decision trees over numpy matrices, for models fitted on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Node:
    """``feature`` is -1 at a leaf; rows with value <= ``cut`` go ``low``."""

    value: float
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None
    conditions: list[tuple[int, bool, float]] = field(default_factory=list)


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int, min_rows: int,
             features: int | None = None, rng: np.random.Generator | None = None,
             conditions: tuple = (), cuts: int = 32) -> Node:
    """Greedy Gini tree.  Candidate cuts are up to ``cuts`` quantiles of the node's
    rows; ``features`` of them (all if None) are tried at each node."""
    node = Node(float(y.mean()) if len(y) else 0.5, conditions=list(conditions))
    if depth == 0 or len(y) < 2 * min_rows or y.min() == y.max():
        return node
    pick = np.arange(x.shape[1])
    if features and rng is not None:
        pick = rng.permutation(pick)[:features]
    best = len(y) * node.value * (1 - node.value) - 1e-9
    for f in pick:
        v = x[:, f]
        found = np.unique(v)
        if len(found) < 2:
            continue
        at = (found[1:] + found[:-1]) / 2
        if len(at) > cuts:
            at = np.unique(np.quantile(v, np.linspace(0.01, 0.99, cuts)))
        order = np.argsort(v, kind="stable")
        ones = np.concatenate([[0.0], np.cumsum(y[order])])
        left = np.searchsorted(v[order], at, side="right")
        n, k, total = left.astype(float), ones[left], ones[-1]
        m = len(y) - n
        with np.errstate(divide="ignore", invalid="ignore"):
            impurity = k * (1 - k / n) + (total - k) * (1 - (total - k) / m)
        impurity[(n < min_rows) | (m < min_rows)] = np.inf
        i = int(np.argmin(impurity))
        if impurity[i] < best:
            best, node.feature, node.cut = float(impurity[i]), int(f), float(at[i])
    if node.feature < 0:
        return node
    low = x[:, node.feature] <= node.cut
    for name, rows, side in (("low", low, False), ("high", ~low, True)):
        setattr(node, name, fit_tree(x[rows], y[rows], depth - 1, min_rows, features, rng,
                                     (*conditions, (node.feature, side, node.cut)), cuts))
    return node


def paths(node: Node) -> list[list[tuple[int, bool, float]]]:
    """The conditions of every node below the root."""
    out = [node.conditions] if node.conditions else []
    for child in (node.low, node.high):
        if child is not None:
            out += paths(child)
    return out


def predict(node: Node, x: np.ndarray) -> np.ndarray:
    if node.feature < 0 or node.low is None or node.high is None:
        return np.full(len(x), node.value)
    low = x[:, node.feature] <= node.cut
    out = np.empty(len(x))
    out[low] = predict(node.low, x[low])
    out[~low] = predict(node.high, x[~low])
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, l1: float = 0.0, l2: float = 0.0,
                 steps: int = 500) -> tuple[float, np.ndarray]:
    """Intercept and weights of a penalised logistic fit, by accelerated proximal
    gradient steps (the intercept is not penalised)."""
    n, k = x.shape
    a = np.hstack([np.ones((n, 1)), x])
    bound = 0.25 * np.linalg.norm(a.T @ a / n, 2) + l2
    w = np.zeros(k + 1)
    z, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ z, -35, 35)))
        g = a.T @ (p - y) / n
        g[1:] += l2 * z[1:]
        new = z - g / bound
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - l1 / bound, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - w)
        if np.abs(new - w).max() < 1e-7:
            w = new
            break
        w, t = new, t_new
    return float(w[0]), w[1:]
