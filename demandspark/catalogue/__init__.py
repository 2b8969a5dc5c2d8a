"""Registered queries and the SQL that checks them."""

from demandspark.catalogue import (  # noqa: F401
    customers, diagnostics, evaluation, files, forecasting, grids, learned, preparation, profiling, scaling,
)
from demandspark.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
