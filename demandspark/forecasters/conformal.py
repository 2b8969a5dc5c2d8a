"""Bands that keep their coverage: quantile tracking along the origins of each series.

The band of a forecaster is widened (or narrowed) by one number for each series and lead.
After every day whose demand is known the number moves up if demand lay outside the band that
was in force, and down if not, by steps whose mean is zero at the wanted coverage. Whatever the
demand does, the share of misses then tends to the wanted one; nothing is assumed of it.
A forecast uses the number as it stood at its own origin, so a lead of ten days is
corrected by what was known ten days before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.functions.chains import alike, padded
from demandspark.shipping import ship_package
from demandspark.spec import DATE, DEMAND, TARGET_DATE, ForecastSpec

# Step for one miss, as a share of the mean absolute error so far.
GAMMA = 0.25
WIDEN = "widen"


def _known_at(targets: list[np.ndarray], origins: list[np.ndarray]) -> np.ndarray:
    """For each row of each chain, how many of its rows have a target at or before the row's origin."""
    out = np.zeros((len(targets), max(map(len, targets), default=0)), np.int64)
    for i, (t, o) in enumerate(zip(targets, origins)):
        out[i, : len(t)] = np.searchsorted(t, o, side="right")
    return out


def track(
    targets: list[np.ndarray], origins: list[np.ndarray], scores: list[np.ndarray], errors: list[np.ndarray],
    miss_rate: float, gamma: float = GAMMA,
) -> np.ndarray:
    """Widening in force for each row; one row a chain, all chains a day at a time.

    Rows of a chain are in order of their targets. ``scores`` say how far demand lies outside
    the band (negative: inside), NaN where there is nothing to learn; ``errors`` are absolute
    misses of the middle.
    """
    known = _known_at(targets, origins)
    chains, width = known.shape
    score, size = padded(scores, width), padded(errors, width)
    state = np.zeros((chains, width + 1))  # after so many rows
    total, seen = np.zeros(chains), np.zeros(chains)
    used = np.zeros((chains, width))
    every = np.arange(chains)
    for k in range(width):
        used[:, k] = state[every, known[:, k]]
        learns = ~np.isnan(score[:, k])
        total += np.where(learns, np.nan_to_num(size[:, k]), 0.0)
        seen += learns
        step = gamma * total / np.maximum(seen, 1)
        outside = (score[:, k] > used[:, k]).astype(float)
        state[:, k + 1] = state[:, k] + np.where(learns, step * (outside - miss_rate), 0.0)
    return used


def widened_bands(
    forecasts: DataFrame, history: DataFrame, coverage: float = 0.8, spec: ForecastSpec = ForecastSpec(),
    gamma: float = GAMMA,
) -> DataFrame:
    """``forecasts`` with the outer quantiles moved so that they cover ``coverage`` of demand, and ``widen``.

    ``forecasts`` hold series, origin, target date and quantiles, one row each; other columns
    are left out. Rows whose target has no demand yet get the number known at their origin;
    rows without a forecast keep their nulls. A chain is one series and lead, bounded by the
    calendar, and travels as one row; chains spread over all tasks. A band never shrinks past
    its middle.
    """
    keys, q = list(spec.keys), spec.quantiles
    actual = history.select(*keys, F.col(DATE).alias(TARGET_DATE), F.col(DEMAND).cast("double").alias("_y"))
    outside = F.greatest(F.col(q.low) - F.col("_y"), F.col("_y") - F.col(q.high))
    known = F.col("_y").isNotNull() & F.col(q.low).isNotNull() & F.col(q.high).isNotNull()
    row = F.struct(
        F.unix_date(TARGET_DATE).alias("t"), F.unix_date(DATE).alias("o"), F.when(known, outside).alias("s"),
        F.when(known, F.abs(F.col("_y") - F.col(q.mid))).alias("e"), *[F.col(n).cast("double").alias(n) for n in q.names],
    )
    rows = (
        forecasts.join(actual.hint("merge"), [*keys, TARGET_DATE], "left")
        .groupBy(*keys, F.datediff(TARGET_DATE, DATE).alias("_lead"))
        .agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    )
    fields = ["t", "o", "s", "e", *q.names]
    chains = rows.select(*keys, *[F.col(f"_rows.{f}").alias(f) for f in fields])
    kept = [*keys, "t", "o", *q.names]
    schema = T.StructType([*[chains.schema[c] for c in kept], T.StructField(WIDEN, T.ArrayType(T.DoubleType()))])
    miss_rate = 1.0 - coverage

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            numbers = [[np.asarray(x, float) for x in b[c]] for c in ("t", "o", "s", "e")]
            widen: list = [None] * len(b)
            for some in alike([len(t) for t in numbers[0]]):
                used = track(*[[x[i] for i in some] for x in numbers], miss_rate, gamma)
                for i, u in zip(some, used):
                    widen[i] = u[: len(numbers[0][i])]
            yield b[kept].assign(**{WIDEN: widen})

    ship_package(forecasts.sparkSession)
    tracked = chains.mapInPandas(run, schema)
    days = F.explode(F.arrays_zip("t", "o", *q.names, WIDEN)).alias("p")
    wide = tracked.select(*keys, days).select(
        *keys, F.date_from_unix_date("p.o").alias(DATE), F.date_from_unix_date("p.t").alias(TARGET_DATE),
        *[F.when(~F.isnan(f"p.{n}"), F.col(f"p.{n}")).alias(n) for n in q.names], f"p.{WIDEN}",
    )
    low, mid, high = F.col(q.low), F.col(q.mid), F.col(q.high)
    return wide.withColumns({
        q.low: F.when(low.isNotNull(), F.least(low - F.col(WIDEN), mid)),
        q.high: F.when(high.isNotNull(), F.greatest(high + F.col(WIDEN), mid)),
    })
