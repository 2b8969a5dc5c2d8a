"""Golomb-Rice codes of sorted sets of integers, in numpy.

A set is coded as the gaps between its members: quotients by 2^k in unary, remainders in
k bits, with k next to the optimum for members spread evenly over their universe.
"""

from __future__ import annotations

import numpy as np


def rice_parameter(n: int, bits: int) -> int:
    """k for ``n`` values spread evenly over ``bits`` bits."""
    gap = (1 << bits) / max(n, 1) * 0.69
    return max(0, int(np.log2(max(gap, 1.0))))


def encode(values: np.ndarray, bits: int) -> tuple[int, bytes, bytes]:
    """(k, unary part, remainders) of sorted distinct unsigned values below 2^bits."""
    k = rice_parameter(len(values), bits)
    gaps = np.diff(values, prepend=np.uint64(0))
    stops = np.cumsum((gaps >> np.uint64(k)) + np.uint64(1)).astype(np.int64) - 1
    unary = np.ones(stops[-1] + 1 if len(stops) else 0, np.uint8)
    unary[stops] = 0
    shifts = np.arange(k, dtype=np.uint64)
    remainders = (gaps[:, None] >> shifts[None, :]).astype(np.uint8) & 1
    return k, np.packbits(unary).tobytes(), np.packbits(remainders.ravel()).tobytes()


def decode(n: int, k: int, unary: bytes, remainders: bytes) -> np.ndarray:
    """The sorted values again."""
    if not n:
        return np.zeros(0, np.uint64)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    quotients = (np.diff(stops, prepend=-1) - 1).astype(np.uint64)
    low = np.unpackbits(np.frombuffer(remainders, np.uint8), count=n * k).reshape(n, k).astype(np.uint64)
    weights = np.uint64(1) << np.arange(k, dtype=np.uint64)
    return np.cumsum((quotients << np.uint64(k)) + (low * weights[None, :]).sum(axis=1, dtype=np.uint64), dtype=np.uint64)
