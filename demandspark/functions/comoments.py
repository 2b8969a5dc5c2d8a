"""Pairwise-complete means, variances and covariances of many columns from one scan."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.shipping import ship_package
from demandspark.staging import staged

_PARTS = ("n", "mx", "my", "cxx", "cyy", "cxy")
# Spread of a column, relative to its mean, that double precision cannot tell from none.
_FLAT = 1e-14


class _Sums:
    """Sums over pairs of columns, about the first value seen of each, so constants give exact zeros."""

    def __init__(self, width: int):
        self.origin = np.full(width, np.nan)
        self.n, self.x, self.xx, self.xy = (np.zeros((width, width)) for _ in range(4))

    def add(self, rows: np.ndarray) -> None:
        known = ~np.isnan(rows)
        for j in np.flatnonzero(np.isnan(self.origin) & known.any(axis=0)):
            self.origin[j] = rows[known[:, j].argmax(), j]
        there = known.astype(float)
        off = np.where(known, rows - np.nan_to_num(self.origin), 0.0)
        self.n += there.T @ there
        self.x += off.T @ there
        self.xx += (off * off).T @ there
        self.xy += off.T @ off

    def parts(self) -> dict[str, np.ndarray]:
        """For each pair (i, j): rows with both, mean of i and of j, and co-moments about them."""
        n = np.maximum(self.n, 1.0)
        x, y = self.x / n, self.x.T / n
        origin = np.nan_to_num(self.origin)
        found = (
            self.n, origin[:, None] + x, origin[None, :] + y, self.xx - n * x * x, self.xx.T - n * y * y, self.xy - n * x * y
        )
        return dict(zip(_PARTS, found))


def comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j, n, mx, my, cxx, cyy, cxy`` for each pair of columns i <= j, over rows where both are present.

    Each task keeps one matrix for each sum, whatever its rows; the tasks' parts (as many
    rows as pairs) are merged about the common means, so nothing cancels out.
    """
    ship_package(df.sparkSession)
    width = len(columns)
    low, high = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(width)
        for batch in batches:
            values = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]
            sums.add(np.column_stack(values) if values else np.zeros((0, width)))
        parts = {name: pa.array(m[low, high]) for name, m in sums.parts().items()}
        yield pa.RecordBatch.from_pydict({"i": pa.array(low, pa.int32()), "j": pa.array(high, pa.int32())} | parts)

    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{k}") for k, c in enumerate(columns)])
    schema = "i int, j int, " + ", ".join(f"{p} double" for p in _PARTS)
    parts = staged(doubles.mapInArrow(run, schema).where("n > 0"), "co-moments")
    means = parts.groupBy("i", "j").agg(
        (F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("ax"), (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("ay")
    )
    x, y, n = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay"), F.col("n")
    return parts.join(means, ["i", "j"]).groupBy("i", "j").agg(
        F.sum("n").alias("n"), F.first("ax").alias("mx"), F.first("ay").alias("my"),
        F.sum(F.col("cxx") + n * x * x).alias("cxx"), F.sum(F.col("cyy") + n * y * y).alias("cyy"),
        F.sum(F.col("cxy") + n * x * y).alias("cxy"),
    )


def correlation(moments: DataFrame):
    """Column: Pearson correlation, null where a side is constant or there are fewer than two rows."""
    c = F.col

    def varies(spread: str, mean: str):
        return c(spread) > c("n") * F.pow(c(mean) * _FLAT, 2)

    clear = (c("n") > 1) & varies("cxx", "mx") & varies("cyy", "my")
    return F.when(clear, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c("cxy") / (F.sqrt("cxx") * F.sqrt("cyy")))))
