"""Isolation trees as NumPy arrays: what one task does with its own small sample or batch."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

EULER_GAMMA = 0.5772156649

# Send these functions to executors inside the closures, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def mean_unsuccessful_search(rows: float) -> float:
    """c(m): mean path length of a search that fails in a binary tree of m rows."""
    if rows <= 1:
        return 0.0
    if rows == 2:
        return 1.0
    return 2.0 * (np.log(rows - 1.0) + EULER_GAMMA) - 2.0 * (rows - 1.0) / rows


def tree_depth(sample_rows: int) -> int:
    return max(1, int(np.ceil(np.log2(max(sample_rows, 2)))))


def grow_tree(x: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
    """One tree as a complete binary tree: split feature and threshold per inner node, path
    length per bottom node.  A leaf above the bottom sends every row left (threshold +inf)."""
    inner = (1 << depth) - 1
    feature = np.zeros(inner, dtype=np.int32)
    threshold = np.full(inner, np.inf)
    path = np.zeros(1 << depth)
    pending = [(0, 0, np.arange(len(x)))]
    while pending:
        node, level, members = pending.pop()
        low, high = (x[members].min(0), x[members].max(0)) if len(members) else (np.zeros(1), np.zeros(1))
        varying = np.flatnonzero(high > low)
        if level == depth or varying.size == 0:
            bottom = ((node + 1) << (depth - level)) - 1 - inner
            path[bottom] = level + mean_unsuccessful_search(len(members))
            continue
        chosen = varying[rng.integers(varying.size)]
        cut = rng.uniform(low[chosen], high[chosen])
        cut = cut if cut < high[chosen] else low[chosen]
        feature[node], threshold[node] = chosen, cut
        goes_right = x[members, chosen] > cut
        pending.append((2 * node + 1, level + 1, members[~goes_right]))
        pending.append((2 * node + 2, level + 1, members[goes_right]))
    return feature, threshold, path


def mean_path_lengths(
    x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, path: np.ndarray
) -> np.ndarray:
    """Mean path length of each row; ``x`` is rows by features, the others trees by nodes.

    All rows of the batch walk one tree level at a time, in buffers made once per batch.  Values lie
    feature by feature, so the root, where all rows compare one feature, reads them in order.
    """
    rows = len(x)
    depth = int(path.shape[1]).bit_length() - 1
    flat, lane = np.ascontiguousarray(x.T).ravel(), np.arange(rows)
    total, value, cut = np.zeros(rows), np.empty(rows), np.empty(rows)
    node, place, right = np.empty(rows, np.intp), np.empty(rows, np.intp), np.empty(rows, bool)
    for f, t, p in zip(feature.astype(np.intp) * rows, threshold, path, strict=True):
        np.greater(flat[f[0] : f[0] + rows], t[0], out=right)
        np.add(right, 1, out=node, casting="unsafe")
        for _ in range(depth - 1):
            np.take(f, node, out=place, mode="clip")
            np.add(place, lane, out=place)
            np.take(flat, place, out=value, mode="clip")
            np.take(t, node, out=cut, mode="clip")
            np.greater(value, cut, out=right)
            np.add(node, node, out=node)
            np.add(node, right, out=node, casting="unsafe")
            node += 1
        node -= f.size
        np.take(p, node, out=value, mode="clip")
        total += value
    return total / len(feature)
