"""Gradient-boosted trees on numeric tables of any size, which are read as sums only.

Trees grow a level at a time. A level asks for the sums of gradients and weights by node, feature and value
of all rows; whoever holds the rows adds them up (`level_sums`), wherever they lie. Gradients are whole
numbers of `_UNIT` and leaves lie on a grid of `GRID`, so neither order nor partitions change a model."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

_UNIT = 1 << 24  # parts of one in which gradients are counted
GRID = 1 << 10  # parts of one in which scores are counted


@dataclass(frozen=True)
class Tree:
    """A complete binary tree: node i has the children 2i+1 and 2i+2; rows go right if the
    feature exceeds the bound."""

    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        node = descend(x, self.feature, self.bound, int(np.log2(len(self.leaf))))
        return self.leaf[node - len(self.feature)]


def descend(x: np.ndarray, feature: np.ndarray, bound: np.ndarray, level: int) -> np.ndarray:
    """The node that each row reaches at a level."""
    node = np.zeros(len(x), np.int64)
    for _ in range(level):
        right = x[np.arange(len(x)), feature[node]] > bound[node]
        node = 2 * node + 1 + right
    return node


@dataclass(frozen=True)
class Boosted:
    start: float
    trees: tuple[Tree, ...]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        return self.start + sum((tree.values(x) for tree in self.trees), np.zeros(len(x)))


# node, feature, value, sum of gradients, sum of weights; sorted by the first three
Sums = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
Ask = Callable[[Boosted, np.ndarray, np.ndarray, int], Sums]


def level_sums(
    x: np.ndarray, y: np.ndarray, counts: np.ndarray, model: Boosted, feature: np.ndarray,
    bound: np.ndarray, level: int,
) -> Sums:
    """Sums of some rows, of which there are `counts` each, for a level of the tree after `model`."""
    p = 1 / (1 + np.exp(-np.clip(model.scores(x), -500, 500)))
    gradient = np.rint((y - p) * _UNIT) * counts
    weight = np.rint(p * (1 - p) * _UNIT) * counts
    first = 2**level - 1
    node = descend(x, feature, bound, level) - first
    found = []
    for f in range(x.shape[1]):
        whole = x.dtype.kind == "u"
        values, which = (np.arange(int(x[:, f].max(initial=0)) + 1), x[:, f]) if whole else np.unique(x[:, f], return_inverse=True)
        key = node * len(values) + which
        there = np.flatnonzero(np.bincount(key))
        g, h = np.bincount(key, gradient)[there], np.bincount(key, weight)[there]
        at, value = np.divmod(there, max(len(values), 1))
        found.append((at + first, np.full(len(there), f), values[value].astype(float), g, h))
    node, f, value, g, h = (np.concatenate(column) for column in zip(*found))
    return node, f, value, g.astype(np.int64), h.astype(np.int64)


def boost(
    rows: int, positives: int, ask: Ask, trees: int = 30, depth: int = 3, rate: float = 0.3, ridge: float = 1.0
) -> Boosted:
    """Log-loss boosting with Newton leaves on all rows that `ask` adds up; deterministic."""
    share = min(max(positives / rows, 1e-3), 1 - 1e-3) if rows else 0.5
    model = Boosted(_on_grid(np.log(share / (1 - share))), ())
    inner = 2**depth - 1
    for _ in range(trees if rows else 0):
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        leaf = np.zeros(inner + 1)
        for level in range(depth):
            node, f, value, g, h = ask(model, feature, bound, level)
            for own in range(2**level - 1, 2 ** (level + 1) - 1):
                mine = np.flatnonzero(node == own)
                if not len(mine):
                    continue
                table = f[mine], value[mine], g[mine] / _UNIT, h[mine] / _UNIT
                feature[own], bound[own] = _split(*table, ridge)
                if level == depth - 1:
                    for right in (0, 1):
                        side = (table[0] == feature[own]) & ((table[1] > bound[own]) == right)
                        step = table[2][side].sum() / (table[3][side].sum() + ridge)
                        leaf[2 * own + 1 + right - inner] = _on_grid(rate * step)
        model = Boosted(model.start, (*model.trees, Tree(feature, bound, leaf)))
    return model


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3,
    ridge: float = 1.0,
) -> Boosted:
    """The same on rows in memory. `y` is 0 or 1."""
    once = np.ones(len(y))
    return boost(len(y), int(y.sum()), lambda *tree: level_sums(x, y, once, *tree), trees, depth, rate, ridge)


def _on_grid(score: float) -> float:
    return float(np.rint(score * GRID) / GRID)


def _split(feature, value, gradient, weight, ridge) -> tuple[int, float]:
    """The split that gains most; (0, inf) if none gains."""
    best = (1e-9, 0, np.inf)
    for f in np.unique(feature).tolist():
        own = feature == f
        values, g, h = value[own], np.cumsum(gradient[own]), np.cumsum(weight[own])
        total, mass = g[-1], h[-1]
        g, h = g[:-1], h[:-1]
        if not len(g):
            continue
        gain = g**2 / (h + ridge) + (total - g) ** 2 / (mass - h + ridge) - total**2 / (mass + ridge)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float(values[k] + values[k + 1]) / 2)
    return best[1], best[2]
