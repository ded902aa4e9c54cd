"""Gradient-boosted trees on small numeric features: fitted in numpy on distinct rows with
their counts, applied as one SQL expression."""

from __future__ import annotations

import numpy as np

ROUNDS, DEPTH, RATE, LEAST = 30, 3, 0.3, 5
#: A tree: a leaf value, or (feature, threshold, tree if feature <= threshold, other tree).
Tree = float | tuple


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, n: np.ndarray, depth: int) -> Tree:
    total_g, total_h = grad.sum(), hess.sum()
    leaf = float(-RATE * total_g / (total_h + 1.0))
    if depth == 0 or n.sum() < 2 * LEAST:
        return leaf
    best, found = 1e-6 + total_g**2 / (total_h + 1.0), None
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v = x[order, f]
        g, h, seen = np.cumsum(grad[order]), np.cumsum(hess[order]), np.cumsum(n[order])
        cut = np.flatnonzero(v[1:] != v[:-1])
        cut = cut[(seen[cut] >= LEAST) & (seen[-1] - seen[cut] >= LEAST)]
        if not len(cut):
            continue
        gain = g[cut] ** 2 / (h[cut] + 1.0) + (total_g - g[cut]) ** 2 / (total_h - h[cut] + 1.0)
        at = int(gain.argmax())
        if gain[at] > best:
            best, found = float(gain[at]), (f, float((v[cut[at]] + v[cut[at] + 1]) / 2))
    if not found:
        return leaf
    f, t = found
    left = x[:, f] <= t
    return f, t, _grow(x[left], grad[left], hess[left], n[left], depth - 1), _grow(x[~left], grad[~left], hess[~left], n[~left], depth - 1)


def _value(tree: Tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, t, left, right = tree
    return np.where(x[:, f] <= t, _value(left, x), _value(right, x))


def fit_trees(x: np.ndarray, y: np.ndarray, n: np.ndarray | None = None) -> tuple[float, list[Tree]]:
    """Bias and trees whose sum is the log odds of y; a row counts n times."""
    n = np.ones(len(y), np.int64) if n is None else n
    bias = float(np.log(((n * y).sum() + 1) / ((n * (1 - y)).sum() + 1)))
    score, trees = np.full(len(y), bias), []
    for _ in range(ROUNDS if len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = _grow(x, n * (p - y), n * p * (1 - p), n, DEPTH)
        trees.append(tree)
        score = score + _value(tree, x)
    return bias, trees


def predict(model: tuple[float, list[Tree]], x: np.ndarray) -> np.ndarray:
    score = np.full(len(x), model[0])
    for tree in model[1]:
        score = score + _value(tree, x)
    return 1 / (1 + np.exp(-score))


def _tree_sql(tree: Tree, names: list[str]) -> str:
    if not isinstance(tree, tuple):
        return f"{tree!r}D"
    f, t, left, right = tree
    return f"IF({names[f]} <= {t!r}D, {_tree_sql(left, names)}, {_tree_sql(right, names)})"


def as_sql(model: tuple[float, list[Tree]], names: list[str]) -> str:
    """The probability, over columns of these names."""
    total = " + ".join([f"{model[0]!r}D", *[_tree_sql(t, names) for t in model[1]]])
    return f"(1D / (1D + exp(-({total}))))"
