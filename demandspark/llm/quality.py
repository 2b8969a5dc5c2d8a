"""Operator 1: quality by hierarchical empirical Bayes.

1. A classifier on character n-grams and measures of style, trained on a bounded sample of the labelled rows
   (about ``fit_rows`` of each label, chosen by a hash), scores every document on its
   whole text. Document frequencies cover all documents.
2. Grouped aggregation sums, for each path and each host, the evidence of its documents:
   the label where there is one, else the classifier's probability.
3. Moments over all hosts, and over all paths about their hosts, give the strengths of
   two beta priors: a host is shrunk towards the global rate, a path towards its host,
   the more the fewer documents it has.
4. A document's posterior odds are its own evidence times the odds of its path, in which
   the document itself is left out.

Sites are joined as tables of one row for each path; the planner broadcasts them only
below its threshold and splits hot sites otherwise. ``documents`` holds no URL: the query
takes ``source`` as the host and ``lang`` as the section under it.

Defined cases: null or empty text is scored as an empty text; null hosts and paths are
sites of their own; ids pass as they are, null or repeated; repeated labels are averaged;
without labels of both kinds the classifier says 0.5 throughout; an empty table gives an
empty table; columns of any other name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import table, text_stage
from demandspark.llm.ngram_regression import Regression, document_frequencies, fit_on, inverse_frequencies, styled_counts
from demandspark.llm.registry import query
from demandspark.staging import staged

FIT_ROWS = 2000
KEEP = 0.5
_STRENGTHS = (1.0, 1e4)
_RATE = (0.02, 0.98)  # a site alone never settles a document
_EDGE = 1e-6


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(_EDGE)), F.lit(1 - _EDGE))
    return F.log(p / (1 - p))


def classifier(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Regression | None:
    """A model of ``docs`` (id, text) by ``labels`` (id, y): classes '0' and '1'."""
    sizes = {int(r["y"]): r["n"] for r in labels.where("y in (0, 1)").groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    spread = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.when(F.col("y") == 1, min(1.0, fit_rows / sizes[1])).otherwise(min(1.0, fit_rows / sizes[0]))
    chosen = staged(labels.where("y in (0, 1)").where(spread < rate).select("id", F.col("y").cast("int").cast("string").alias("label")), "quality-sample")
    idf = inverse_frequencies(*document_frequencies(docs))
    return fit_on(docs.join(chosen, "id").select("text", "label"), ["0", "1"], idf, styled_counts)


def _strength(stats: DataFrame, mean: Column) -> float:
    """Prior strength of groups (n, s) about ``mean``, by moments of their rates."""
    rate = F.col("s") / F.col("n")
    row = stats.agg(
        F.sum(F.col("n") * (rate - mean) ** 2).alias("spread"), F.sum(mean * (1 - mean)).alias("noise"),
        F.sum("n").alias("n"), F.avg(mean * (1 - mean)).alias("unit"),
    ).first()
    if not row["n"]:
        return _STRENGTHS[1]
    between = (row["spread"] - row["noise"]) / row["n"]
    strength = row["unit"] / between - 1 if between > 0 else _STRENGTHS[1]
    return min(max(strength, _STRENGTHS[0]), _STRENGTHS[1])


def posterior(scored: DataFrame, prior_logit: float = 0.0) -> DataFrame:
    """``scored`` (staged; host, path, p, y or null) with ``host_rate``, ``path_rate`` and ``quality``."""
    evidence = F.coalesce("y", "p")
    keys = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")).alias(f"{c}_key") for c in ("host", "path")]
    rows = scored.select("*", *keys, evidence.alias("_e"))
    paths = staged(rows.groupBy("host_key", "path_key").agg(F.count("*").alias("n"), F.sum("_e").alias("s")), "paths")
    hosts = staged(paths.groupBy("host_key").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    mean = F.lit(total["s"] / total["n"] if total["n"] else 0.5)
    k_host = F.lit(_strength(hosts, mean))

    def shrunk(s: Column, n: Column, k: Column, to: Column) -> Column:
        return (s + k * to) / (n + k)

    named = hosts.select("host_key", F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    sites = staged(
        paths.join(named, "host_key").withColumn("host_rate", shrunk(F.col("host_s"), F.col("host_n"), k_host, mean)),
        "sites",
    )
    k_path = F.lit(_strength(sites, F.col("host_rate")))
    sites = sites.drop("host_rate")
    e = F.col("_e")
    host_rate = shrunk(F.col("host_s") - e, F.col("host_n") - 1, k_host, mean)
    path_rate = shrunk(F.col("s") - e, F.col("n") - 1, k_path, F.col("host_rate"))
    bounded = F.least(F.greatest(F.col("path_rate"), F.lit(_RATE[0])), F.lit(_RATE[1]))
    return (
        rows.join(sites, ["host_key", "path_key"])
        .withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
        .withColumn("quality", 1 / (1 + F.exp(-(logit(F.col("p")) - prior_logit + logit(bounded)))))
        .select(*scored.columns, "host_rate", "path_rate", "quality")
    )


def judge(docs: DataFrame, labels: DataFrame, host: str, path: str, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """``id``, ``host``, ``path``, ``p``, ``y``, ``host_rate``, ``path_rate`` and ``quality`` for each row of ``docs``."""
    slim = docs.select(
        F.col(id_col).alias("id"), F.col(text).alias("text"),
        F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"),
    )
    known = staged(
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(id_col).alias("id")).agg(F.avg(F.col(label).cast("double")).alias("y")),
        "labels",
    )
    model = classifier(slim.select("id", "text"), known)

    def work(texts):
        return {"p": [0.5 if model is None else float(model.probabilities(t or "")[1]) for t in texts]}

    scored = staged(text_stage(slim, "text", "p double", lambda: work), "document-evidence")
    return posterior(staged(scored.join(known, "id", "left"), "evidence"))


@query("op1_quality")
def op1_quality(spark, sf_dir):
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "source", "lang")
    return judged.select(
        F.col("id").alias("doc_id"), F.col("p").alias("doc_score"), "host_rate", "path_rate", "quality",
        (F.col("quality") >= KEEP).alias("kept"),
    )
