"""Quantile forecasters: ``fit(history)`` gives a parameter table, ``predict`` scores a grid."""

from demandspark.forecasters.base import Forecaster
from demandspark.forecasters.iterative import iterative_forecast
from demandspark.forecasters.naive import SeasonalNaive
from demandspark.forecasters.quantile_regression import QuantileRegression
from demandspark.forecasters.regression import LagRegression
from demandspark.forecasters.selection import backtest, candidate_errors, select_candidate
from demandspark.forecasters.smoothing import ExponentialSmoothing
from demandspark.forecasters.trailing import TrailingQuantile
from demandspark.forecasters.weekday import WeekdayQuantile

__all__ = [
    "ExponentialSmoothing",
    "Forecaster",
    "LagRegression",
    "QuantileRegression",
    "SeasonalNaive",
    "TrailingQuantile",
    "WeekdayQuantile",
    "backtest",
    "candidate_errors",
    "iterative_forecast",
    "select_candidate",
]
