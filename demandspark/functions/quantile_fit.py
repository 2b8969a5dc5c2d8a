"""Linear quantile regression over a distributed table.

The pinball loss is smoothed by a logistic kernel, so that Newton's method applies, and
the kernel is narrowed in stages. Each iteration is one pass: every task adds up loss,
gradient and curvature of all models, and a small aggregate merges the tasks' sums. No rows
reach the driver, and what does has the size of the models.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.shipping import ship_package

NARROWING = 0.25
STAGES = 7
MAX_PASSES = 120
_SETTLED = 1e-10
_RIDGE = 1e-10
_WINDOW_ROWS = 8  # rows that the narrowest kernel should see, for each weight


@dataclass
class _Model:
    """One level on the rows before one block."""

    level: float
    before: int | None
    weights: np.ndarray
    tried: np.ndarray
    scale: np.ndarray  # root mean square of each feature
    width: float
    narrowest: float
    loss: float = np.inf
    done: bool = False

    def narrower(self) -> None:
        if self.width <= self.narrowest:
            self.done = True
        self.width = max(self.width * NARROWING, self.narrowest)
        self.loss = np.inf
        self.tried = self.weights

    def update(self, loss: float, slope: np.ndarray, curve: np.ndarray) -> None:
        """Newton's step from what a pass found at ``tried``; half the last one where the loss rose."""
        if not loss <= self.loss * (1 + 1e-12):
            move = self.tried - self.weights
            if np.abs(move).max() < 1e-9 * max(1.0, np.abs(self.weights).max()):
                self.narrower()
            else:
                self.tried = self.weights + move / 2
            return
        self.weights, self.loss = self.tried, loss
        curve = curve / np.outer(self.scale, self.scale)
        mean = np.trace(curve) / len(curve)
        if mean <= 0.0:  # no row within the kernel
            self.done = True
            return
        step = np.linalg.solve(curve + _RIDGE * mean * np.eye(len(curve)), slope / self.scale) / self.scale
        if slope @ step <= _SETTLED * max(loss, 1e-300):
            self.narrower()
        else:
            self.tried = self.weights + step


def _sums(models: list[_Model], x: np.ndarray, y: np.ndarray, block: np.ndarray, out: np.ndarray) -> None:
    """Add loss, slope and curvature of each model over the rows of one batch."""
    rows, before = slice(None), None
    for i, m in enumerate(models):
        if i == 0 or m.before != before:
            before = m.before
            rows = slice(None) if before is None else block < before
            xs, ys = x[rows], y[rows]
        if not len(ys):
            continue
        miss = ys - xs @ m.tried
        z = miss / m.width
        soft = np.logaddexp(0.0, -z)
        share = np.exp(-z - soft)  # of the kernel below the fit
        d = x.shape[1]
        out[i, 0] += m.level * miss.sum() + m.width * soft.sum()
        out[i, 1 : d + 1] += xs.T @ (m.level - share)
        weight = share * (1.0 - share) / m.width
        out[i, d + 1 :] += ((xs * weight[:, None]).T @ xs).ravel()


def _pass(rows: DataFrame, models: list[_Model], width: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(models), 1 + width + width * width))
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            _sums(models, np.column_stack(columns[2:]).astype(float), columns[1].astype(float), columns[0], out)
        yield pa.RecordBatch.from_pydict({
            "at": pa.array(np.arange(out.size), pa.int64()), "s": pa.array(out.ravel(), pa.float64()),
        })

    # One row for each number of the models, summed map-side within each task.
    found = rows.mapInArrow(run, "at long, s double").groupBy("at").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros((len(models), 1 + width + width * width))
    out.ravel()[found["at"].to_numpy()] = found["s"].to_numpy()
    return out


def fit_quantiles(
    rows: DataFrame, features: Sequence[str], label: str, levels: Sequence[float],
    block: str | None = None, starts: Sequence[int] = (),
) -> dict[tuple[int | None, float], list[float]]:
    """Weights by (start, level) of linear quantiles of ``label`` over staged ``rows``.

    With ``block`` there is a model for each of ``starts``, fitted on the rows of earlier
    blocks only; else one for all rows (start None). Rows with a null are left out; a model
    without rows has no entry. Features that are alike share their weight.
    """
    ship_package(rows.sparkSession)
    names = [*features, label]
    width = len(features)
    there = rows.dropna(subset=names).select(
        (F.col(block).cast("long") if block else F.lit(0).cast("long")).alias("b"), F.col(label).cast("double").alias("y"),
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
    )
    squares = [F.sum(F.col(f"x{i}") * F.col(f"x{i}")) for i in range(width)]
    sums = F.array(F.count("*").cast("double"), F.sum("y"), F.sum(F.col("y") * F.col("y")), F.sum(F.abs("y")), *squares)
    of_block = {r["b"]: np.array(r["s"]) for r in there.groupBy("b").agg(sums.alias("s")).collect()}
    models = []
    for start in starts if block else [None]:
        # What a model starts from is that of its own rows.
        own = [s for b, s in sorted(of_block.items()) if start is None or b < start]
        if not own:
            continue
        n, total, square, size, *scale = np.sum(own, axis=0)
        spread = max(math.sqrt(max(square / n - (total / n) ** 2, 0.0)), 1e-6 * size / n, 1e-12)
        narrowest = spread * max(NARROWING**STAGES, min(1.0, _WINDOW_ROWS * width / n) if block else 0.0)
        scale = np.sqrt(np.maximum(np.array(scale) / n, 1e-300))
        zero = np.zeros(width)
        models += [_Model(level, start, zero, zero, scale, spread + size / n, narrowest) for level in levels]
    for _ in range(MAX_PASSES):
        open_ = [m for m in models if not m.done]
        if not open_:
            break
        for m, s in zip(open_, _pass(there, open_, width)):
            m.update(s[0], s[1 : width + 1], s[width + 1 :].reshape(width, width))
    return {(m.before, m.level): m.weights.tolist() for m in models}


def pinball(miss, level: float):
    """Column: the pinball loss of ``label - fit``."""
    return F.greatest(miss * level, miss * (level - 1.0))
