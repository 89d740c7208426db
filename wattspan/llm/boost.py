"""Histogram gradient-boosted trees for two classes, and their flattened form.

Features are cut at quantiles of the training rows into bins; every level of a
tree sums gradients and curvatures per (node, bin) and takes the best cut. Trees
are complete and lie in arrays, one row per tree, so that scoring walks all rows
of a batch through a level at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Node k of a tree has children 2k+1 and 2k+2; leaves are numbered below the last level."""

    prior: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _best_cuts(binned, gradient, curvature, node, nodes, bins, ridge, least):
    """Feature and bin of the best cut of every node (bin -1: none)."""
    gains = np.full((nodes, binned.shape[1], bins), -np.inf)
    for f in range(binned.shape[1]):
        at = node * bins + binned[:, f]
        g = np.bincount(at, gradient, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
        h = np.bincount(at, curvature, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
        n = np.bincount(at, minlength=nodes * bins).reshape(nodes, bins).cumsum(axis=1)
        all_g, all_h, all_n = g[:, -1:], h[:, -1:], n[:, -1:]
        gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
        gains[:, f] = np.where((n >= least) & (all_n - n >= least), gain, -np.inf)
    best = gains.reshape(nodes, -1).argmax(axis=1)
    worth = gains.reshape(nodes, -1)[np.arange(nodes), best] > 1e-6
    return best // bins, np.where(worth, best % bins, -1)


def fit(x, y, trees=60, depth=4, rate=0.2, bins=64, ridge=5.0, least=20) -> Trees:
    """Fit on rows ``x`` (float64, no missing values) and labels 0 and 1.

    Without rows, or with one class only, the trees are empty and the score is the prior.
    """
    x, y = np.asarray(x, float), np.asarray(y, float)
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    prior = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(np.unique(y)) < 2:
        none = np.zeros((0, inner))
        return Trees(prior, none.astype(np.int64), none, np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], axis=1)
    raw = np.full(len(y), prior)
    found = []
    for _ in range(trees):
        p = sigmoid(raw)
        gradient, curvature = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, first = 2**level, 2**level - 1
            features, at = _best_cuts(binned, gradient, curvature, node, nodes, bins, ridge, least)
            for k in np.flatnonzero(at >= 0):
                e = edges[features[k]]
                if at[k] < len(e):
                    feature[first + k], cut[first + k] = features[k], e[at[k]]
            here = first + node
            node = 2 * node + (x[np.arange(len(y)), feature[here]] > cut[here])
        g = np.bincount(node, gradient, leaves)
        h = np.bincount(node, curvature, leaves)
        leaf = -rate * g / (h + ridge)
        raw += leaf[node]
        found.append((feature, cut, leaf))
    return Trees(prior, *(np.stack(part) for part in zip(*found)))


def score(model: Trees, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for every row."""
    raw, rows = np.full(len(x), model.prior), np.arange(len(x))
    for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
        node = np.zeros(len(x), np.int64)
        while len(node) and node[0] < len(feature):  # all rows are on one level
            node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
        raw += leaf[node - len(feature)] if len(node) else 0.0
    return sigmoid(raw)
