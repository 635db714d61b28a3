"""Gradient-boosted regression trees of one small series, grown level by level.

Squared loss, from the mean of the training labels on. A split sends a row left
if its value is at most the cut; cuts lie midway between neighbouring training
values (at most ``BINS`` values a feature, evenly spaced in rank beyond). Gains
are GL^2/(NL+1) + GR^2/(NR+1) - G^2/(N+1) over residual sums and row counts; gains
within 1e-9 of the best count as equal and the first feature, then the smallest
cut, is taken. A node that gains no more than 1e-6 is a leaf of rate * G/(N+1).
"""

from __future__ import annotations

import numpy as np

BINS, LEAST_GAIN, EQUAL = 256, 1e-6, 1e-9


def cuts(values: np.ndarray) -> np.ndarray:
    """Sorted places to cut a feature with these training values."""
    v = np.unique(values)
    mid = (v[:-1] + v[1:]) / 2
    return mid if len(mid) < BINS else mid[np.linspace(0, len(mid) - 1, BINS - 1).astype(int)]


def boosted_scores(x: np.ndarray, y: np.ndarray, train: np.ndarray, trees: int, depth: int, rate: float) -> np.ndarray:
    """Predictions for all rows of ``x`` (rows by features) of a model fitted to the rows marked in ``train``."""
    at = [cuts(column[train]) for column in x.T]
    code = np.stack([np.searchsorted(c, column) for c, column in zip(at, x.T)])  # features by rows
    score = np.full(len(x), y[train].mean())
    seen = code[:, train]
    by_code = np.argsort(seen, axis=1, kind="stable")  # training rows in the order of each feature
    each = np.arange(len(at))[:, None]

    for _ in range(trees):
        rest = np.where(train, y - score, 0.0)
        own_rest = rest[train]
        node, leaf, nodes = np.zeros(len(x), int), np.zeros(len(x)), 1  # node -1: the row is in a leaf
        for level in range(depth + 1):
            own = node[train]
            inside = own >= 0
            g = np.bincount(own[inside], own_rest[inside], nodes)
            n = np.bincount(own[inside], minlength=nodes)
            split = np.zeros(nodes, bool)
            if level < depth:
                # rows by node, then by the feature's value: the nodes lie alike in every feature
                rows = np.take_along_axis(by_code, np.argsort(
                    np.where(inside, own, nodes).astype(np.min_scalar_type(nodes))[by_code], axis=1, kind="stable"), axis=1)[:, :n.sum()]
                start = np.cumsum(n) - n
                of = np.repeat(np.arange(nodes), n)
                run = own_rest[rows].cumsum(axis=1)
                run0 = np.concatenate([np.zeros((len(at), 1)), run], axis=1)[:, start]
                gl = run - run0[:, of]
                nl = np.arange(len(of)) - start[of] + 1
                gain = gl ** 2 / (nl + 1) + (g[of] - gl) ** 2 / (n[of] - nl + 1) - (g ** 2 / (n + 1))[of]
                value = seen[each, rows]
                last = np.ones(gain.shape, bool)  # a cut lies behind the last row of a value that is not the node's last
                last[:, :-1] = value[:, :-1] != value[:, 1:]
                gain[~last | (nl == n[of])] = -np.inf
                best = np.maximum.reduceat(gain, start, axis=1).max(axis=0)
                split = best > LEAST_GAIN
                equal = gain >= np.where(split, (1 - EQUAL) * best, np.inf)[of]
                feature = np.logical_or.reduceat(equal, start, axis=1).argmax(axis=0)
                here = np.where(equal[feature[of], np.arange(len(of))], np.arange(len(of)), len(of) - 1)
                cut = value[feature, np.minimum.reduceat(here, start)]
            done = (node >= 0) & ~split[node]
            leaf[done] = rate * (g / (n + 1))[node[done]]
            node[done] = -1
            if not split.any():
                break
            number = np.cumsum(split) - 1  # children of the k-th split node: 2k and 2k + 1
            on = np.flatnonzero(node >= 0)
            parent = node[on]
            node[on] = 2 * number[parent] + (code[feature[parent], on] > cut[parent])
            nodes = 2 * int(split.sum())
        score = score + leaf
    return score
