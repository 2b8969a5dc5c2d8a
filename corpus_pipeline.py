"""Corpus pipeline: language, exact copies, near copies, secrets, packing.

Each stage takes the documents that the stage before kept and returns the columns of
``documents``; the last returns the pieces of the packed sequences. ``run`` writes each
stage's rows as Parquet to the shared folder and hands the written table to the next, so a
lost executor costs at most the tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandspark.llm import exact_dedup, language_id, packing, secrets, simhash
from demandspark.llm.common import table
from demandspark.staging import staged

# The learnt stages (languages, secrets) have no SQL form; tests hold the pipeline against
# a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents in no known language go."""
    return language_id.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of equal texts the longest row stays."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of each group of near duplicates one document stays."""
    return simhash.keep_one(docs)


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: secrets are masked; no document goes."""
    return secrets.mask(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: the texts tokenised and packed; one row for each piece, with its ids."""
    return packing.packed_documents(docs)


STAGES = [
    ("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies),
    ("secret_spans", secret_spans), ("sequences", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
