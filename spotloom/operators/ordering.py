"""Order of the leaves of a hierarchical clustering, for matrices that are small after aggregation (items of a codebook by rois)."""

from __future__ import annotations

import numpy as np


def ward_merges(x: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of clusters in the order in which they merge: rows of x are clusters 0 to n - 1, the k-th merge makes cluster n + k. Each time
    the pair goes whose union raises the sum of squared distances to the means least; of ties the first."""
    n = len(x)
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    names, size, merges = list(range(n)), np.ones(n), []
    for k in range(n - 1):
        a, b = sorted(map(int, np.unravel_index(d.argmin(), d.shape)))
        merges.append((names[a], names[b]))
        both = size[a] + size[b]
        new = ((size[a] + size) * d[a] + (size[b] + size) * d[b] - size * d[a, b]) / (both + size)
        new[[a, b]] = np.inf
        d[a], d[:, a], size[a], names[a] = new, new, both, n + k
        d, size = np.delete(np.delete(d, b, 0), b, 1), np.delete(size, b)
        del names[b]
    return merges


def leaf_order(x: np.ndarray) -> list[int]:
    """The order of the rows of x along Ward's tree, its branches turned so that the sum of distances between neighbours is least; read from
    the end with the smaller number."""
    n = len(x)
    if n < 2:
        return list(range(n))
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    leaves: dict[int, list[int]] = {i: [i] for i in range(n)}
    cost: dict[int, np.ndarray] = {i: np.zeros((1, 1)) for i in range(n)}  # least sum by first and last leaf
    parts: dict[int, tuple[int, int]] = {}

    def least_sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.stack([(row[:, None] + b).min(0) for row in a])

    for k, (a, b) in enumerate(ward_merges(x)):
        across = least_sums(least_sums(cost[a], dist[np.ix_(leaves[a], leaves[b])]), cost[b])
        m, size = len(leaves[a]), len(leaves[a]) + len(leaves[b])
        cost[n + k] = np.full((size, size), np.inf)
        cost[n + k][:m, m:], cost[n + k][m:, :m] = across, across.T
        leaves[n + k], parts[n + k] = leaves[a] + leaves[b], (a, b)

    def ordered(node: int, first: int, last: int) -> list[int]:
        if node not in parts:
            return [first]
        a, b = parts[node]
        if first not in leaves[a]:
            return ordered(node, last, first)[::-1]
        i, j = leaves[a].index(first), leaves[b].index(last)
        sums = cost[a][i][:, None] + dist[np.ix_(leaves[a], leaves[b])] + cost[b][:, j][None]
        p, q = np.unravel_index(sums.argmin(), sums.shape)
        return ordered(a, first, leaves[a][p]) + ordered(b, leaves[b][q], last)

    top = 2 * n - 2
    i, j = np.unravel_index(cost[top].argmin(), cost[top].shape)
    out = ordered(top, leaves[top][i], leaves[top][j])
    return out if out[0] < out[-1] else out[::-1]
