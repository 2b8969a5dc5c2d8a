"""Many chains (rows of one series in order of time) as matrices, a step of all of them at once."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Cells of one matrix.
CELLS = 1 << 20


def alike(lengths: Sequence[int], cells: int = CELLS) -> Iterator[np.ndarray]:
    """Positions of chains of like length, so many at a time that their matrix has at most ``cells`` cells."""
    order = np.argsort(lengths, kind="stable")
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * lengths[order[stop]] <= cells:
            stop += 1
        yield order[start:stop]
        start = stop


def padded(values: Sequence[np.ndarray], width: int) -> np.ndarray:
    """One row a chain, NaN beyond its end."""
    out = np.full((len(values), width), np.nan)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out
