"""One day at a time: each forecast's middle quantile becomes the next day's history."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandspark.shipping import ship_package
from demandspark.spec import COUNTRY, DATE, DEMAND, FORECAST_STEP, ForecastSpec
from demandspark.staging import staged


def _row_quantiles(ordered: np.ndarray, counts: np.ndarray, p: float) -> np.ndarray:
    """Interpolated quantile of the first ``counts`` values of each ascending row."""
    position = p * np.maximum(counts - 1, 0)
    below = np.floor(position).astype(int)
    above = np.ceil(position).astype(int)
    rows = np.arange(len(ordered))
    low, high = (np.where(counts > 0, ordered[rows, at], 0.0) for at in (below, above))
    return np.where(counts > 0, low + (high - low) * (position - below), np.nan)


def _recursion(spec: ForecastSpec):
    """The recursion for a batch of series at a time: one row in per series, one out per step."""
    q, width, n_steps = spec.quantiles, spec.trailing_rows, spec.iterative_steps

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = batch["_tail"].map(lambda t: 0 if t is None else len(t)).to_numpy()
            empty = counts == 0  # nothing to go by: null at every step
            # Free places sort behind every value.
            recent = np.full((len(batch), width), np.inf)
            filled = np.arange(width) < counts[:, None]
            if filled.any():
                recent[filled] = np.concatenate([t for t in batch["_tail"] if t is not None])
            oldest = np.zeros(len(batch), dtype=int)
            rows = np.arange(len(batch))
            series = batch[[*spec.keys, "_last"]]
            for step in range(1, n_steps + 1):
                ordered = np.sort(recent, axis=1)
                levels = {n: _row_quantiles(ordered, counts, p) for n, p in q.levels}
                yield series.assign(_step=step, **levels)
                full = counts == width
                recent[rows, np.where(full, oldest, counts % width)] = levels[q.mid]
                oldest = np.where(full, (oldest + 1) % width, oldest)
                counts = np.where(empty, 0, np.minimum(counts + 1, width))

    return run


def iterative_forecast(train: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """``iterative_steps`` daily forecasts per series, starting after the country's last date.

    A series enters with its last ``trailing_rows`` demands only - the ranked filter is
    applied map-side as well, so a long series is cut before the shuffle. The recursion
    then runs over Arrow batches of series: no job per step and no growing lineage.
    A series without any demand keeps its rows, with null quantiles.
    """
    keys, q = list(spec.keys), spec.quantiles
    latest = staged(train.groupBy(COUNTRY).agg(F.max(DATE).alias("_last")), "last-dates")
    newest = Window.partitionBy(*keys).orderBy(F.col(DATE).desc())
    tails = (
        train.where(F.col(DEMAND).isNotNull())
        .select(*keys, DATE, DEMAND, F.row_number().over(newest).alias("_back"))
        .where(F.col("_back") <= spec.trailing_rows)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct(DATE, DEMAND))).alias("_rows"))
        .select(*keys, F.transform("_rows", lambda r: r[DEMAND]).alias("_tail"))
    )
    every = train.select(*keys).distinct()
    tails = every.join(tails, keys, "left").join(latest, COUNTRY).select(*keys, "_last", "_tail")
    ship_package(train.sparkSession)
    schema = T.StructType(
        [
            *[tails.schema[c] for c in [*keys, "_last"]],
            T.StructField("_step", T.IntegerType()),
            *[T.StructField(n, T.DoubleType()) for n in q.names],
        ]
    )
    return tails.mapInPandas(_recursion(spec), schema).select(
        *keys,
        F.date_add(F.col("_last"), F.col("_step") * spec.freq_days).alias(DATE),
        F.col("_step").alias(FORECAST_STEP),
        *[F.when(~F.isnan(n), F.col(n)).alias(n) for n in q.names],
    )


def point_forecast_column(forecasts: DataFrame, spec: ForecastSpec = ForecastSpec()) -> DataFrame:
    """Series, date and the middle quantile as ``ForecastDemand``."""
    return forecasts.select(*spec.keys, DATE, F.col(spec.quantiles.mid).alias("ForecastDemand"))
