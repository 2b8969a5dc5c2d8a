"""The whole diagnosis of many series at once: one keyed table per section."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.operators.diagnose import (
    autocorrelation, branch_patterns, forecast_consistency, iqr_outliers, outlier_report,
    outliers_by_weekday, seasonal_patterns,
)
from demandspark.operators.validate import assert_daily_grain
from demandspark.spec import ForecastSpec


def full_diagnosis(
    history: DataFrame, evaluation: DataFrame, wanted: DataFrame, spec: ForecastSpec = ForecastSpec()
) -> dict[str, DataFrame]:
    """All sections for the wanted series that exist; shares of a branch count all its series.

    ``history`` and ``evaluation`` feed several sections: pass tables or staged frames
    when they are expensive to derive.
    """
    assert_daily_grain(history, spec.keys)
    keys = [k for k in spec.keys if k in wanted.columns]
    wanted = wanted.select(*keys).distinct()
    rows = history.join(wanted, keys, "left_semi")
    forecasts = evaluation.join(wanted, keys, "left_semi")
    return {
        "branch_patterns": branch_patterns(history, spec).join(wanted, keys, "left_semi"),
        "seasonal_patterns": seasonal_patterns(rows, spec),
        "outliers": iqr_outliers(rows, spec),
        "outlier_report": outlier_report(rows, spec),
        "outliers_by_weekday": outliers_by_weekday(rows, spec),
        "autocorrelation": autocorrelation(rows, spec=spec),
        "forecast_consistency": forecast_consistency(forecasts, spec),
        "history": rows,
        "forecast": forecasts,
    }


def section_counts(sections: dict[str, DataFrame]) -> DataFrame:
    """Rows per section."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("section"), "n_rows")
        for name, df in sections.items()
    ]
    return reduce(DataFrame.unionByName, counts)
