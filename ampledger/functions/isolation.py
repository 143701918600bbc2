"""Isolation trees on plain arrays: the small helpers that run inside tasks."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Python workers need not have this package installed: its functions travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def check_sample(h: pd.Series, size: int, keys: list[str]) -> None:
    """Raise where the sample of a tree shows that the keys repeat."""
    if len(h) != size or 2 * h.nunique() < size:
        raise ValueError(f"columns {keys} do not tell the rows apart; sampling needs a unique key")


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points: 2 H(n-1) - 2 (n-1)/n."""
    if n <= 2:
        return float(n == 2)
    return 2.0 * (np.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def grow_tree(points: np.ndarray, tree: int, seed: int) -> pd.DataFrame:
    """One isolation tree over at most a few hundred points, as a full binary tree.

    The children of node i are 2i + 1 and 2i + 2. A branch that ends early gives
    its path length to all bottom nodes below it, whatever the splits between.
    """
    rng = np.random.default_rng([seed, tree])
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    feature = np.zeros(2 ** (limit + 1) - 1, dtype=np.int32)
    split = np.zeros(len(feature))
    path = np.zeros(len(feature))

    def grow(rows: np.ndarray, node: int, depth: int) -> None:
        sample = points[rows]
        low, high = (sample.min(axis=0), sample.max(axis=0)) if len(rows) else (np.zeros(1), np.zeros(1))
        varying = np.flatnonzero(high > low)
        if depth == limit or len(varying) == 0:
            width = 2 ** (limit - depth)
            first = (node + 1) * width - 1
            path[first : first + width] = depth + expected_path(len(rows))
            return
        feature[node] = rng.choice(varying)
        split[node] = rng.uniform(low[feature[node]], high[feature[node]])
        is_right = sample[:, feature[node]] >= split[node]
        grow(rows[~is_right], 2 * node + 1, depth + 1)
        grow(rows[is_right], 2 * node + 2, depth + 1)

    grow(np.arange(len(points)), 0, 0)
    columns = {"tree": tree, "node": np.arange(len(feature)), "feature": feature, "split": split, "path": path}
    return pd.DataFrame(columns)


def path_lengths(points: np.ndarray, nodes: dict[str, np.ndarray], depth: int) -> np.ndarray:
    """Average path length of each point over all trees; ``nodes`` holds arrays (trees, nodes)."""
    n = len(points)
    values = np.ascontiguousarray(points.T).ravel()
    rows = np.arange(n)
    total = np.zeros(n)
    for feature, split, path in zip(nodes["feature"], nodes["split"], nodes["path"]):
        start = feature.astype(np.int64) * n
        node = np.zeros(n, dtype=np.int64)
        for _ in range(depth):
            is_right = values[start[node] + rows] >= split[node]
            node = 2 * node + 1 + is_right
        total += path[node]
    return total / len(nodes["path"])
