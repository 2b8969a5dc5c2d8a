"""Operators for training-data pipelines; nothing else in the library imports this subpackage."""

from demandspark.llm import (  # noqa: F401
    byte_bpe, exact_dedup, language_id, line_quality, merkle, packing, prefix_counts, quality, secrets,
    shingle_join, simhash, spelling, warc,
)
from demandspark.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
