"""Forests of BK-trees over 64-bit fingerprints, in numpy.

A child hangs on its parent by their integer Hamming distance. All trees of a batch grow
one level at a time: the items that stand at a node are grouped by their distance to it,
the first of each group becomes the child, the others stand at it. A search of radius r
that finds distance d at a node follows only edges from d - r to d + r; all searches of a
batch advance together.
"""

from __future__ import annotations

import numpy as np

_EDGE = 65  # distances are below this
_FRONT = 1 << 18


class Forest:
    """Trees of the groups in ``group`` (sorted); values are distinct within a group."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        self.values = values
        n = len(values)
        first = np.flatnonzero(np.diff(group, prepend=-1)) if n else np.zeros(0, np.int64)
        self.root = {int(group[i]): int(i) for i in first}
        sizes = np.diff(np.append(first, n))
        at = np.repeat(first, sizes)
        items = np.flatnonzero(at != np.arange(n))
        at = at[items]
        edges, children = [], []
        while len(items):
            distance = np.bitwise_count(values[items] ^ values[at]).astype(np.int64)
            key, where, back = np.unique(at * _EDGE + distance, return_index=True, return_inverse=True)
            child = items[where]
            edges.append(key)
            children.append(child)
            at = child[back]
            stay = items != at
            items, at = items[stay], at[stay]
        self.edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(self.edge)
        self.edge = self.edge[order]
        self.child = np.concatenate(children)[order] if edges else np.zeros(0, np.int64)

    def search(self, queries: np.ndarray, roots: np.ndarray, radius: int):
        """Yields (query numbers, node numbers) within the radius, root by root of each query."""
        stack = [(np.arange(len(queries)), roots)]
        while stack:
            who, node = stack.pop()
            if len(who) > _FRONT:
                half = len(who) // 2
                stack += [(who[:half], node[:half]), (who[half:], node[half:])]
                continue
            distance = np.bitwise_count(queries[who] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            if hit.any():
                yield who[hit], node[hit]
            low = np.searchsorted(self.edge, node * _EDGE + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edge, node * _EDGE + np.minimum(distance + radius, _EDGE - 1), "right")
            count = high - low
            total = int(count.sum())
            if total:
                skip = np.repeat(low - np.cumsum(count) + count, count)
                stack.append((np.repeat(who, count), self.child[skip + np.arange(total)]))
