"""Operator 9: language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of character n-grams (one to three code points of the
lower-cased text) hashed into 2^14 buckets, scaled to unit length. Document frequencies
are counted over every labelled training row. The weights are trained with
follow-the-regularised-leader (per-coordinate rates, L1 and L2 penalties), which leaves
most of them zero, and the scores are calibrated by one temperature on rows kept out of
the fit.

Training rows: non-null label, crc32 of the id as text modulo 3 not 1. Every label is
learnt. The fit takes a bounded sample, about ``fit_rows`` rows of each label, or an equal
share of ``fit_rows * FULL_LANGUAGES`` where there are more labels than ``FULL_LANGUAGES``,
chosen by a hash of where a row is stored, so that copies of a text are taken one by one;
counts and scores take every row and the whole text. The model has DIMENSIONS weights for
each label and travels inside the tasks.

Defined cases: null text, and text without a letter, is ``und`` with score 0; so is all
text when there is nothing to learn from. A null id counts as not held out. Other columns
pass as they are, null or repeated; a column of a new column's name is replaced; an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import ROW, keyed, stored, table, text_stage, without
from demandspark.llm.ngram_regression import Regression, document_frequencies, fit_on, inverse_frequencies
from demandspark.llm.registry import query
from demandspark.staging import staged

UNKNOWN = "und"
FIT_ROWS = 1500
# So many labels get ``fit_rows`` each; more share what these would take.
FULL_LANGUAGES = 200
# Calibrated score below which the corpus pipeline rejects a document.
MIN_SCORE = 0.4


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def held_out(id_col: str = "doc_id"):
    """Column: is a row kept out of the training."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang", fit_rows: int = FIT_ROWS
) -> Regression | None:
    """A model learnt from the training rows of ``docs``; None if there are none."""
    training = keyed(docs).select(
        *ROW, F.col(f"rec.{id_col}").alias("id"), F.col(f"rec.{text}").alias("text"),
        F.col(f"rec.{label}").cast("string").alias("label"),
    ).where(F.col("label").isNotNull() & F.col("text").isNotNull() & ~held_out("id")).drop("id")
    sizes = {r["label"]: r["n"] for r in training.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not sizes:
        return None
    idf = inverse_frequencies(*document_frequencies(training))
    spread = F.pmod(F.xxhash64(*ROW), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = fit_rows * min(1.0, FULL_LANGUAGES / len(sizes))
    rates = docs.sparkSession.createDataFrame([(c, min(1.0, rows / n)) for c, n in sizes.items()], "label string, rate double")
    sample = training.join(staged(rates, "language-rates"), "label").where(spread < F.col("rate"))
    return fit_on(sample, sorted(sizes), idf)


def predict(docs: DataFrame, model: Regression | None, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``lang_pred`` and ``score``."""

    def one(t: str | None) -> tuple[str, float]:
        if model is None or not has_letter(t):
            return UNKNOWN, 0.0
        p = model.probabilities(t)
        return model.classes[int(p.argmax())], float(p.max())

    def work(texts):
        found = [one(t) for t in texts]
        return {"lang_pred": [c for c, _ in found], "score": [s for _, s in found]}

    return text_stage(docs, text, "lang_pred string, score double", lambda: work)


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``docs`` without rows in no known language (``und``, or a score below ``min_score``)."""
    docs = stored(docs)
    model = train(docs)
    judged = predict(keyed(docs).select(*ROW, F.col("rec.text").alias("text")), model)
    lost = judged.where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_score)).select(*ROW)
    return without(docs, staged(lost, "unknown-language"))


@query("op9_language_id")
def op9_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predict(docs.drop("lang"), train(docs)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )
