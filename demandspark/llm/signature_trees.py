"""Signature trees over token sets, in numpy: OR-combined bitmaps, size ranges, dual traversal.

Sets are sorted arrays of 64-bit token hashes. A leaf's bitmap has a bit for each token
(its highest bits); a node ORs FAN children and knows the range of their sizes and the
largest ``spare``, the number of a set's tokens less its bits. Two sets below nodes A and
B have at most ``popcount(A & B) + min(spare)`` tokens in common, so a pair of nodes goes
when that is too little for the smallest sizes below it, when the size ranges cannot meet,
or when all below both is one component already. Surviving pairs of leaves are counted
exactly.
"""

from __future__ import annotations

import numpy as np

FAN = 8
_MAX_BITS = 15
_FRONT = 1 << 14
_CELLS = 1 << 24


class Tree:
    """Levels of nodes, leaves first. ``place`` maps leaves to the caller's set numbers."""

    def __init__(self, sets: list[np.ndarray], place: np.ndarray, bits: int):
        sizes = np.array([len(sets[i]) for i in place], np.int64)
        low = np.array([sets[i][0] for i in place], np.uint64)
        order = np.lexsort((low, np.floor(np.log(sizes) / np.log(1.25))))  # like beside like
        self.place, sizes = place[order], sizes[order]
        width = 1 << bits
        maps = np.zeros((len(sizes), width // 64), np.uint64)
        step = max(1, _CELLS // width)
        for a in range(0, len(sizes), step):
            part = [sets[i] for i in self.place[a : a + step]]
            on = np.zeros((len(part), width), bool)
            on[np.repeat(np.arange(len(part)), sizes[a : a + step]), (np.concatenate(part) >> np.uint64(64 - bits)).astype(np.int64)] = True
            maps[a : a + step] = np.packbits(on, axis=1).view(np.uint64)
        self.maps, self.low, self.high = [maps], [sizes], [sizes]
        self.spare = [sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)]

    def grow(self) -> None:
        """Add the next level."""
        at = np.arange(0, len(self.maps[-1]), FAN)
        self.maps.append(np.bitwise_or.reduceat(self.maps[-1], at, axis=0))
        self.low.append(np.minimum.reduceat(self.low[-1], at))
        self.high.append(np.maximum.reduceat(self.high[-1], at))
        self.spare.append(np.maximum.reduceat(self.spare[-1], at))

    def labels(self, label: np.ndarray, level: int) -> np.ndarray:
        """The component of all sets below each node, -1 where there are several."""
        low = high = label[self.place]
        for _ in range(level):
            at = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        return np.where(low == high, low, -1)


def _children(tree: Tree, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first child, number of children) of nodes of ``level``."""
    first = node * FAN
    return first, np.minimum(FAN, len(tree.maps[level - 1]) - first)


class Join:
    """Links among sets, as a spanning forest. 100 * |A and B| >= percent * |A or B| links A and B."""

    def __init__(self, sets: list[np.ndarray], label: np.ndarray, percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.label = np.unique(label, return_inverse=True)[1]
        self.links: list[tuple[int, int]] = []

    def linked(self, overlap, sizes):
        return (100 + self.percent) * overlap >= self.percent * sizes

    def _verify(self, left: np.ndarray, right: np.ndarray) -> None:
        order = np.argsort(left, kind="stable")
        left, right = left[order], right[order]
        starts = np.flatnonzero(np.append(True, left[1:] != left[:-1]))
        for a, b in zip(starts, [*starts[1:], len(left)]):
            x, ys = int(left[a]), right[a:b]
            ys = ys[self.label[ys] != self.label[x]]
            if not len(ys):
                continue
            mine, sizes = self.sets[x], self.sizes[ys]
            tokens = np.concatenate([self.sets[y] for y in ys])
            at = np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)
            overlap = np.add.reduceat((mine[at] == tokens).astype(np.int64), np.cumsum(sizes) - sizes)
            ys = ys[self.linked(overlap, sizes + len(mine))]
            if len(ys):
                joined, first = np.unique(self.label[ys], return_index=True)
                self.links += [(x, int(y)) for y in ys[first]]
                self.label[np.isin(self.label, joined)] = self.label[x]

    def run(self, a: np.ndarray, b: np.ndarray | None = None) -> None:
        """Links within the sets ``a``, or between ``a`` and ``b`` (set numbers)."""
        if len(a) == 0 or (b is not None and len(b) == 0):
            return
        both = a if b is None else np.concatenate([a, b])
        bits = int(np.clip(np.ceil(np.log2(16 * np.median(self.sizes[both]))), 6, _MAX_BITS))
        one = Tree(self.sets, a, bits)
        two = one if b is None else Tree(self.sets, b, bits)
        while len(one.maps[-1]) > 1 or len(two.maps[-1]) > 1:
            one.grow()
            if two is not one:
                two.grow()
        stack = [(len(one.maps) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, x, y = stack.pop()
            if len(x) > _FRONT:
                half = len(x) // 2
                stack += [(level, x[half:], y[half:]), (level, x[:half], y[:half])]
                continue
            mine, other = one.labels(self.label, level)[x], two.labels(self.label, level)[y]
            open_ = (mine != other) | (mine < 0)
            open_ &= (100 * one.high[level][x] >= self.percent * two.low[level][y])
            open_ &= (100 * two.high[level][y] >= self.percent * one.low[level][x])
            x, y = x[open_], y[open_]
            common = np.bitwise_count(one.maps[level][x] & two.maps[level][y]).sum(axis=1, dtype=np.int64)
            common += np.minimum(one.spare[level][x], two.spare[level][y])
            open_ = self.linked(common, one.low[level][x] + two.low[level][y])
            x, y = x[open_], y[open_]
            if not len(x):
                continue
            if level == 0:
                left, right = one.place[x], two.place[y]
                self._verify(left[left != right], right[left != right])
                continue
            fx, nx = _children(one, level, x)
            fy, ny = _children(two, level, y)
            count = nx * ny
            pair = np.repeat(np.arange(len(x)), count)
            k = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
            cx, cy = fx[pair] + k // ny[pair], fy[pair] + k % ny[pair]
            if two is one:  # each pair once
                cx, cy = cx[cx <= cy], cy[cx <= cy]
            stack.append((level - 1, cx, cy))
