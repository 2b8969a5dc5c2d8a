r"""Operator 10: secret scans by rules and a character convolutional network.

One pass over the texts finds the rules' spans and, beside them, every other candidate (a
run of 16 or more key characters with a letter and a digit). The network sees a candidate
with its surroundings; it is trained on all labelled findings (those of the rules against
the other candidates, whatever their number and length, copies one by one) but one in
``ASIDE``, calibrated on all of those set aside, and cut at the largest threshold that
keeps ``recall`` of their positives. Candidates above it are added as kind ``model``; the
rules' spans always stay, whatever their score. Shards of the findings are trained on at
once and the networks averaged after each round; scale and threshold come from sums and
counts over all scores. What is learnt depends on the findings alone, not on where they
are stored. No shuffle but of the findings' windows and of networks.

Rules, leftmost and not overlapping within a kind, failing matches dropped:
assign ``(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)``
in either case with 6 or more characters in the value, access ``AKIA[A-Z0-9]+`` of 20 or
more, hex ``[0-9a-f]+`` of 24 or more. Places are code points, ends exclusive.

Defined cases: null text counts as empty and has no span; ids and other columns pass as
they are, null or repeated; columns of any name pass; an empty table gives an empty table. Without findings of both
labels to learn from and one of the rules' set aside there is no network, and the rules' spans are all.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, groupby, islice
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandspark.llm.char_cnn import BATCH, CharCnn, platt, platt_sums, symbols
from demandspark.llm.common import ROW, arrow_stage, keyed, partition_count, table, text_stage
from demandspark.llm.registry import query
from demandspark.staging import staged

KINDS = ("assign", "access", "hex", "model")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_OTHER = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_LETTER, _DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")
CONTEXT = 24
RECALL = 0.98
ASIDE = 4  # one in so many findings sets scale and threshold
SHARD = 4096  # findings that one task learns from in a round
ROUNDS = 4
MASK = "[SECRET]"


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the rules' findings, in order."""
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, rules: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of other runs of key characters that touch no finding of the rules."""
    starts = [a for a, _, _ in rules]
    reach = [0, *accumulate((b for _, _, b in rules), max)]  # furthest end of the first rules
    return [
        (m.start(), m.end()) for m in _OTHER.finditer(text)
        if _LETTER.search(m[0]) and _DIGIT.search(m[0]) and reach[bisect_left(starts, m.end())] <= m.start()
    ]


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``rules`` and ``others``.

    Arrays of (kind, start, stop, window): the window holds the symbols of the finding and
    its surroundings.
    """

    def work(texts):
        out = {"rules": [], "others": []}
        for t in texts:
            t = t or ""
            rules = rule_spans(t)
            row = lambda k, a, b: {"kind": k, "start": a, "stop": b, "window": symbols(t, a, b, CONTEXT).tobytes()}  # noqa: B023, E731
            out["rules"].append([row(k, a, b) for a, k, b in rules])
            out["others"].append([row(3, a, b) for a, b in candidates(t, rules)])
        return out

    span = "array<struct<kind: int, start: long, stop: long, window: binary>>"
    return text_stage(docs, text, f"rules {span}, others {span}", lambda: work)


def train(found: DataFrame, fit_rows: int | None = None, recall: float = RECALL) -> CharCnn | None:
    """A network learnt from staged ``findings`` of rows with their identity; None without examples enough.

    Every finding counts; ``fit_rows`` is for callers who want a quicker network of about so
    many findings of each label.
    """
    sizes = found.agg(F.sum(F.size("rules")).alias("yes"), F.sum(F.size("others")).alias("no")).first()
    if not sizes["yes"] or not sizes["no"]:
        return None

    def of(column: str, label: int, size: int) -> DataFrame:
        spread = F.pmod(F.xxhash64(*ROW, "kind", "start"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        rows = found.select(*ROW, F.explode(column).alias("s")).select(*ROW, "s.kind", "s.start", F.col("s.window").alias("w"))
        return (rows if fit_rows is None else rows.where(spread < min(1.0, fit_rows / size))).select("w", F.lit(label).alias("label"))

    # Equal windows travel as one row with their number, and are dealt and set aside one by one.
    both = of("rules", 1, sizes["yes"]).unionByName(of("others", 0, sizes["no"]))
    turn = F.pmod(F.xxhash64(F.lit("aside"), "w", "label"), F.lit(ASIDE))
    apart = F.expr(f"(turn + n + {ASIDE - 1}) div {ASIDE} - (turn + {ASIDE - 1}) div {ASIDE}")  # multiples of ASIDE in turn...turn + n - 1
    examples = both.groupBy("w", "label").agg(F.count("*").alias("n")).withColumn("turn", turn)
    whole = staged(examples.withColumn("apart", apart), "secret-examples")
    size = {r[0]: tuple(r)[1:] for r in whole.groupBy("label").agg(F.sum("apart"), F.sum(F.col("n") - F.col("apart"))).collect()}
    (yes, fit_yes), (no, fit_no) = size.get(1, (0, 0)), size.get(0, (0, 0))
    if not (yes and fit_yes and fit_no):
        return None
    net = _learnt(whole, fit_yes, fit_no)
    return net and _calibrated(net, whole, yes, no, recall)


def _learnt(whole: DataFrame, n_yes: int, n_no: int) -> CharCnn | None:
    """A network that went ROUNDS times over the examples not set aside, both labels of like weight in all.

    In each round every shard of some SHARD examples goes on from the same network in one
    task; the networks are averaged.
    """
    shards = -(-(n_yes + n_no) // SHARD)
    weights = (n_yes + n_no) / (2 * np.array([n_no, n_yes], float))
    first = F.explode(F.expr(f"sequence(0, least(n, {shards}L) - 1)")).alias("first")
    place = F.pmod(F.pmod(F.xxhash64("w", "label"), F.lit(shards)) + F.col("first"), F.lit(shards)).cast("int")
    dealt = whole.select("w", "label", "n", "turn", first).withColumn("shard", place)
    dealt = dealt.repartition(min(shards, partition_count(whole.sparkSession)), "shard")
    rows = dealt.withColumn("copy", F.explode(F.expr(f"sequence(first, n - 1, {shards}L)")))
    rows = rows.select("w", "label", "shard", "copy", (F.pmod(F.col("turn") + F.col("copy"), F.lit(ASIDE)) == 0).alias("aside"))
    schema = "shard int, rows long, state binary"
    arrow = pa.schema([("shard", pa.int32()), ("rows", pa.int64()), ("state", pa.binary())])

    def pass_of(state: np.ndarray):
        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = "shard", "w", "label", "aside"
            for shard, rows in groupby((r for b in batches for r in zip(*(b.column(c).to_pylist() for c in names))), itemgetter(0)):
                net, n, rows = CharCnn().load(state), 0, (r for r in rows if not r[3])
                while part := list(islice(rows, BATCH)):
                    label = np.array([r[2] for r in part])
                    net.step([np.frombuffer(r[1], np.uint8) for r in part], label.astype(float), weights[label])
                    n += len(part)
                if n:
                    yield pa.RecordBatch.from_arrays([[shard], [n], [net.state().tobytes()]], schema=arrow)

        return fit

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in b.to_pylist()]
        if found:
            n, state = _average(found)
            yield pa.RecordBatch.from_arrays([[min(r["shard"] for r in found)], [n], [state.tobytes()]], schema=arrow)

    state = CharCnn().state()
    for k in range(ROUNDS):
        ordered = rows.sortWithinPartitions("shard", F.xxhash64(F.lit(k), "copy", "label", "w"))
        each = arrow_stage(ordered, pass_of(state), schema)
        # In two steps, so that the driver gets the root of the number of networks.
        merged = arrow_stage(each.repartition(math.isqrt(shards)), merge, schema).collect()
        if not merged:
            return None
        _, state = _average(merged)
    return CharCnn().load(state)


def _average(found: list) -> tuple[int, np.ndarray]:
    """(examples, mean state) of networks, in a fixed order."""
    total, n = 0.0, sum(r["rows"] for r in found)
    for r in sorted(found, key=lambda r: r["shard"]):
        total = total + np.frombuffer(r["state"]) * (r["rows"] / n)
    return n, total


def _calibrated(net: CharCnn, whole: DataFrame, yes: int, no: int, recall: float) -> CharCnn:
    """``net`` with its scale and threshold from all examples set aside."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = net.raw([np.frombuffer(w, np.uint8) for w in b.column("w").to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.array(raw), b.column("label"), b.column("apart")], ["raw", "label", "n"])

    apart = whole.where("apart > 0").select("w", "label", "apart")
    scored = staged(arrow_stage(apart, score, "raw double, label int, n long"), "secret-scores")

    def sums(tries: list[tuple[float, float]], high: float, low: float) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(tries), 6))
            for b in batches:
                raw, label, n = (b.column(c).to_numpy() for c in ("raw", "label", "n"))
                total += [platt_sums(raw, np.where(label > 0, high, low), n, *x) for x in tries]
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], ["sums"])

        tasks = arrow_stage(scored, add, "sums array<double>").collect()
        return np.sum([r["sums"] for r in tasks], axis=0).reshape(-1, 6)

    net.slope, net.offset = platt(sums, yes, no)
    sign = 1.0 if net.slope >= 0 else -1.0
    lowest = _ranked(scored.where("label = 1").select((F.col("raw") * sign).alias("x"), "n"), int((1 - recall) * yes))
    net.threshold = float(net.calibrated(lowest * sign))
    return net


def _ranked(values: DataFrame, rank: int) -> float:
    """The ``x`` at place ``rank`` (from 0) in ascending order, each ``x`` standing ``n`` times; narrowed by counts."""
    low, high = values.agg(F.min("x"), F.max("x")).first()
    while low < high:
        here = values.where(F.col("x").between(low, high)).withColumn("bin", F.floor((F.col("x") - low) / (high - low) * 1024))
        for b in here.groupBy("bin").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.sum("n").alias("n")).orderBy("bin").collect():
            if rank < b["n"]:
                low, high = b["low"], b["high"]
                break
            rank -= b["n"]
    return low


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``spans``: (start, kind number, stop), in order.

    ``docs`` holds the identity of its rows (``keyed``).
    """
    found = staged(findings(docs, text), "secret-findings")
    net = train(found)
    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop"))
    kept = [c for c in docs.columns if c != text]
    base = found.withColumn("base", F.transform("rules", plain))
    if net is None:
        return base.select(*kept, F.col("base").alias("spans"))

    def work(rows):
        windows = [np.frombuffer(s["window"], np.uint8) for r in rows for s in r]
        yes = iter((net.score(windows) >= net.threshold).tolist() if windows else [])
        return {"added": [[{"start": s["start"], "kind": s["kind"], "stop": s["stop"]} for s in r if next(yes)] for r in rows]}

    scored = _scored(base.select(*kept, "base", "others"), work)
    return scored.select(*kept, F.array_sort(F.concat("base", "added")).alias("spans"))


def _scored(found: DataFrame, work) -> DataFrame:
    added = "array<struct<start: long, kind: int, stop: long>>"
    schema = found.drop("others").schema.add("added", T._parse_datatype_string(added))

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                extra = work(part.column("others").to_pylist())["added"]
                arrays = [part.column(n) for n in arrow.names[:-1]]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(extra, arrow.types[-1])], schema=arrow)

    return arrow_stage(found, run, schema)


def span_text(column, kinds=KINDS):
    """Column: spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    wanted = F.filter(column, lambda s: s["kind"] < len(kinds))
    return F.array_join(
        F.transform(wanted, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def _masked(text: str, places: list[dict]) -> str:
    parts, at = [], 0
    for s in places:
        if s["stop"] > at:
            if s["start"] >= at:
                parts += [text[at : s["start"]], MASK]
            at = s["stop"]
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by ``MASK`` and ``n_chars`` set anew; same columns.

    Spans that overlap are masked as one; rows without a span are not touched.
    """
    rows = keyed(docs)
    found = spans(rows.select(*ROW, F.col("rec.text").alias("text"))).where(F.size("spans") > 0)
    hit = staged(found, "secret-spans")
    clean = rows.join(hit.select(*ROW), ROW, "left_anti").select("rec.*")

    arrow = to_arrow_schema(docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                rec = dict(zip(arrow.names, part.column("rec").flatten()))
                texts = list(map(_masked, rec["text"].to_pylist(), part.column("spans").to_pylist()))
                rec["text"] = pa.array(texts, arrow.field("text").type)
                if "n_chars" in rec:
                    rec["n_chars"] = pa.array([len(t) for t in texts], arrow.field("n_chars").type)
                yield pa.RecordBatch.from_arrays(list(rec.values()), schema=arrow)

    masked = arrow_stage(rows.join(hit, ROW).select("rec", "spans"), run, docs.schema)
    return clean.unionByName(masked)


@query("op10_secret_scan")
def op10_secret_scan(spark, sf_dir):
    docs = keyed(table(spark, sf_dir, "documents"))
    found = spans(docs.select(*ROW, F.col("rec.doc_id").alias("doc_id"), F.col("rec.text").alias("text")))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text("spans", KINDS[:3]).cast("binary"), 256).alias("base_sha256"),
        span_text("spans").alias("spans"),
    )
