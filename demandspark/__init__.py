"""Daily demand forecasting and diagnostics as Spark DataFrame jobs."""

from demandspark.spec import ForecastSpec, Quantiles

__all__ = ["ForecastSpec", "Quantiles"]
