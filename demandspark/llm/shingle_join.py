r"""Operator 12: documents whose shingle sets have a high Jaccard similarity, by signature trees.

1. One pass over the texts makes each row's set of shingle hashes; rows of one set are one
   node (a huge group of copies combines map-side). Only the set's size and digest stay.
2. Which sets can have a partner at all? Of two linked sets, ordered by hash, at least the
   first ``1 + n // 10`` common tokens lie among the first ``n - 0.8 n + 1 + n // 10`` of each.
   The pass sends these tokens, cut and Golomb-coded, to owners, which answer with bitmaps
   of those that occur again; sets with too few such tokens have no partner. This moves
   some four bytes a token of a third of each set.
3. The sets of the others are made again from their texts and staged.
4. Signature trees: sets that share one of their three lowest hashes are bundled, a large
   bundle is cut at random into shards, and each shard is a tree that is traversed against
   itself. Most links of dense groups show up here, and make components.
5. The rest, exactly: linked sets share one of the first ``n - 0.8 n + 1`` tokens in any
   common order; the order taken is (occurrences by a sketch of fixed size, hash), so
   passages that many documents share come last. Only tokens whose sets are of several
   components count. Tokens whose sets have the same lead (the set of lowest hashed number)
   are one bundle, so that groups with many tokens in common send each set a few times
   and not once a token. A bundle above ``SHARD`` sets is cut into cells, and each pair of
   cells meets in one task. Pairs of nodes within one component are not followed.
6. Tasks reduce links to spanning forests; components take the smallest id.

Words are ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; a set has the distinct runs of five
words (fewer words: the whole sequence). Tokens are 64-bit hashes, sets are told apart by
128 bits. Rows link when 100 * intersection >= 80 * union.

Defined cases: null and empty texts, and texts without words, have an empty set, are linked with
nothing and keep their own id; null ids come last when the smallest is chosen (a component of
null ids alone has a null id); equal texts share a component; texts of any length are hashed
whole; an empty table gives an empty table. Only the id and the text are read, so further
columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandspark.llm import golomb
from demandspark.llm.common import ROW, _slices, arrow_stage, keyed, partition_count, table
from demandspark.llm.components import components
from demandspark.llm.exact_dedup import _answers
from demandspark.llm.registry import query
from demandspark.llm.signature_trees import Join
from demandspark.staging import staged

WORDS, PERCENT = 5, 80
SHARD = 1 << 10
LOWEST = 3
_CUT = 48  # bits of a token that owners see
_SKETCH = 18
_HELD_TOKENS, _HELD_SETS = 1 << 21, 1 << 16
_HELD_WORDS = 1 << 19
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64
)
_NONE = np.zeros(0, np.uint64)


class Shingles:
    """Texts to sorted arrays of distinct shingle hashes; words are hashed once a task."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self._hash, self._known = xxhash.xxh64_intdigest, {}
        self._words = words
        self._factors = [_FACTORS[i % 5] ** np.uint64(1 + 2 * (i // 5)) for i in range(words)]

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return _NONE
        if len(words) < self._words:
            return np.array([self._hash(b" ".join(words), 1)], np.uint64)
        known = self._known
        if len(known) > _HELD_WORDS:
            known.clear()
        try:
            values = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = self._hash(w)
            values = [known[w] for w in words]
        values = np.array(values, np.uint64)
        n = len(values) - self._words + 1
        h = values[:n] * self._factors[0]
        for i in range(1, self._words):
            h += values[i : i + n] * self._factors[i]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(29)
        return np.unique(h)


def least_overlap(n, percent: int):
    """Tokens that a set of ``n`` has in common with any partner, at least."""
    return -(-percent * n // 100)


def _prefix(n: int, percent: int) -> int:
    return n - least_overlap(n, percent) + 1


def _messages(prefixes: list[np.ndarray], sender: int, owner_bits: int) -> dict[str, list]:
    """One row for each owner: the distinct tokens of its range and the sets that have them."""
    inner = _CUT - owner_bits
    values = np.concatenate(prefixes)
    sets = np.repeat(np.arange(len(prefixes)), [len(p) for p in prefixes]).astype(np.uint16)
    order = np.argsort(values, kind="stable")
    values, sets = values[order], sets[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    count = np.diff(np.append(first, len(values)))
    values = values[first]
    owners = (values >> np.uint64(inner)).astype(np.int64)
    low = values & np.uint64((1 << inner) - 1)
    at = np.flatnonzero(np.diff(owners, prepend=-1))
    rows = []
    for a, b in zip(at, [*at[1:], len(values)]):
        k, unary, remainders = golomb.encode(low[a:b], inner)
        many = count[a:b] > 1
        until = first[b] if b < len(first) else len(sets)
        rows.append((
            int(owners[a]), b - a, k, unary, remainders, np.packbits(many).tobytes(),
            count[a:b][many].astype(np.uint32).tobytes(), sets[first[a] : until].tobytes(),
        ))
    names = "owner n k unary remainders again counts sets".split()
    return {name: list(column) for name, column in zip(names, zip(*rows))} | {"sender": [sender] * len(rows)}


def shingled(slim: DataFrame, words: int, percent: int) -> DataFrame:
    """From ``_rf, _ri, id, text`` rows of two kinds: ``_rf, _ri, id, n, digest, sender, set`` of a document, and
    messages (``owner`` not null)."""
    fields = [T.StructField(f.name, f.dataType) for f in slim.schema.fields if f.name != "text"]  # null in messages
    schema = T.StructType(fields + T._parse_datatype_string(
        "digest binary, set int, sender long, owner long, n long, k long, unary binary, remainders binary, "
        "again binary, counts binary, sets binary"
    ).fields)
    arrow = to_arrow_schema(schema)
    owner_bits = max(1, math.ceil(math.log2(partition_count(slim.sparkSession))))

    def batch(columns: dict, rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            c if isinstance(c := columns.get(f.name), pa.Array) else pa.array([None] * rows if c is None else c, f.type)
            for f in arrow
        ], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401
        import xxhash

        shingles = Shingles(words)
        sender = TaskContext.get().partitionId() << 24
        known: dict[bytes, int] = {}
        prefixes: list[np.ndarray] = []
        held = 0
        for whole in batches:
            for part in _slices(whole, "text"):
                n, digests, sets = [], [], []
                for value in part.column("text").to_pylist():
                    tokens = shingles(value)
                    digest = xxhash.xxh3_128_digest(tokens.tobytes()) if len(tokens) else None
                    if digest is not None and digest not in known:
                        known[digest] = len(known)
                        prefixes.append(tokens[: _prefix(len(tokens), percent) + len(tokens) // 10] >> np.uint64(64 - _CUT))
                        held += len(prefixes[-1])
                    n.append(len(tokens))
                    digests.append(digest)
                    sets.append(known.get(digest))
                own = {f.name: part.column(f.name).cast(arrow.field(f.name).type) for f in fields}
                yield batch(own | {"digest": digests, "n": n, "set": sets, "sender": [sender] * len(n)}, len(n))
                if held > _HELD_TOKENS or len(known) > _HELD_SETS - 2000:
                    sent = _messages(prefixes, sender, owner_bits)
                    yield batch(sent, len(sent["owner"]))
                    known, prefixes, held, sender = {}, [], 0, sender + 1
        if prefixes:
            sent = _messages(prefixes, sender, owner_bits)
            yield batch(sent, len(sent["owner"]))

    return arrow_stage(slim, run, schema)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(sender, set, shared): how many tokens sent for a set occur again; input sorted by sender."""

    def found(sender: int, total: np.ndarray) -> pa.RecordBatch:
        sets = np.flatnonzero(total)
        return pa.RecordBatch.from_pydict({
            "sender": pa.array(np.full(len(sets), sender), pa.int64()), "set": pa.array(sets, pa.int32()),
            "shared": pa.array(total[sets], pa.int64()),
        })

    now, total = None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["sender"] != now:
                if now is not None:
                    yield found(now, total)
                now, total = r["sender"], np.zeros(_HELD_SETS, np.int64)
            count = np.ones(r["n"], np.int64)
            many = np.unpackbits(np.frombuffer(r["again"], np.uint8), count=r["n"]).astype(bool)
            count[many] = np.frombuffer(r["counts"], np.uint32)
            named = np.unpackbits(np.frombuffer(r["bitmap"], np.uint8), count=r["n"]).astype(bool)
            total += np.bincount(np.frombuffer(r["sets"], np.uint16)[np.repeat(named, count)], minlength=_HELD_SETS)
    if now is not None:
        yield found(now, total)


def with_partners(made: DataFrame, percent: int) -> DataFrame:
    """``digest`` of the sets of ``made`` (staged) that may have a partner other than copies within a task."""
    sent = made.where("owner IS NOT NULL")
    answers = staged(
        _answers(sent.select("owner", "sender", "n", "k", "unary", "remainders", "again")), "token-bitmaps"
    )
    n = partition_count(made.sparkSession)
    named = sent.select("owner", "sender", "n", "again", "counts", "sets").join(answers, ["owner", "sender"]).drop("owner")
    counts = arrow_stage(
        named.repartition(n, "sender").sortWithinPartitions("sender"), _shared, "sender long, set int, shared long"
    )
    least = F.ceil(F.col("n") * percent / 100)  # the size of the smallest partner
    rows = made.where("owner IS NULL AND n > 0").select("sender", "set", "n", "digest")
    passed = rows.join(counts, ["sender", "set"]).where(F.col("shared") >= 1 + F.floor(least / 10))
    return passed.select("digest").distinct()


def _sets(slim: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``digest, n, tokens`` (binary) and a number ``node`` of the rows that ``rows`` names by ``_rf`` and ``_ri``.

    The rows travel as bitmaps of 64 neighbours, which the planner broadcasts below its
    threshold; beyond it, texts are sorted by them once.
    """
    word = F.shiftright("_ri", 6).alias("_rw")
    bit = F.expr("shiftleft(1L, cast(_ri & 63 as int))")
    marks = staged(rows.groupBy("_rf", word).agg(F.bit_or(bit).alias("marks")), "marked-rows")
    marked = slim.select(*ROW, word, "text").join(marks, ["_rf", "_rw"]).where(F.col("marks").bitwiseAND(bit) != 0).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401
        import xxhash

        shingles = Shingles(words)
        for whole in batches:
            for part in _slices(whole, "text"):
                tokens = [shingles(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({
                    "digest": pa.array([xxhash.xxh3_128_digest(t.tobytes()) for t in tokens], pa.binary()),
                    "n": pa.array([len(t) for t in tokens], pa.int64()),
                    "tokens": pa.array([t.tobytes() for t in tokens], pa.binary()),
                })

    made = arrow_stage(marked, run, "digest binary, n long, tokens binary")
    return staged(made.withColumn("node", F.monotonically_increasing_id()), "shingle-sets")


def _sketch(sets: DataFrame) -> np.ndarray:
    """Tokens of all sets counted by their highest bits; of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << _SKETCH, np.int64)
        for batch in batches:
            for value in batch.column(0):
                tokens = np.frombuffer(value.as_buffer(), np.uint64)
                np.add.at(total, (tokens >> np.uint64(64 - _SKETCH)).astype(np.int64), 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    counts = arrow_stage(sets.select("tokens"), run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << _SKETCH, np.int64)
    out[counts["at"].to_numpy()] = counts["n"].to_numpy()
    return out


def _tokens(sets: DataFrame, pick) -> DataFrame:
    """(token, node): the tokens that ``pick`` takes of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            taken = [pick(np.frombuffer(v.as_buffer(), np.uint64)) for v in batch.column(1)]
            if taken:
                yield pa.RecordBatch.from_pydict({
                    "token": pa.array(np.concatenate(taken).view(np.int64), pa.int64()),
                    "node": pa.array(np.repeat(nodes, [len(t) for t in taken]), pa.int64()),
                })

    return arrow_stage(sets.select("node", "tokens"), run, "token long, node long")


def _tree_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): spanning forests of the links in shards ``(shard, side, node, root)``.

    Where a shard has rows of side 1, only links between the sides are looked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            shard, side = rows["shard"].to_numpy(), rows["side"].to_numpy()
            node, root = rows["node"].to_numpy(), rows["root"].to_numpy()
            first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
            a, b = [], []
            for x, y in zip(first, [*first[1:], len(shard)]):
                sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows["tokens"].slice(x, y - x)]
                join = Join(sets, root[x:y], percent)
                visits = side[x:y] == 1
                if visits.any():
                    join.run(np.flatnonzero(~visits), np.flatnonzero(visits))
                else:
                    join.run(np.arange(y - x))
                a += [node[x + i] for i, _ in join.links]
                b += [node[x + j] for _, j in join.links]
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            shard = held["shard"].to_numpy()
            end = int(np.argmax(shard == shard[-1]))
            if end:
                yield from found(held.slice(0, end))
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield from found(held)

    n = partition_count(sets.sparkSession)
    rows = members.join(sets.select("node", "tokens"), "node").select("shard", "side", "node", "root", "tokens")
    return arrow_stage(rows.repartition(n, "shard").sortWithinPartitions("shard"), run, "a long, b long")


def _bundles(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """(lead, size, node, root): the sets of all tokens (``token, lead``) with one lead, each once."""
    sets = staged(rows.join(tokens, "token").select("lead", "node", "root").distinct(), "bundles")
    sizes = staged(sets.groupBy("lead").agg(F.count("*").alias("size")).where("size > 1"), "bundle-sizes")
    return sets.join(sizes, "lead")


def _lead():
    return F.min(F.xxhash64("node")).alias("lead")


def _low_hash_links(sets: DataFrame, percent: int, shard: int) -> DataFrame:
    rows = staged(_tokens(sets, lambda t: t[:LOWEST]).withColumn("root", F.col("node")), "low-hashes")
    tokens = rows.groupBy("token").agg(F.count("*").alias("size"), _lead()).where("size > 1").select("token", "lead")
    part = F.pmod(F.xxhash64("node", "lead"), F.ceil(F.col("size") / shard))
    members = _bundles(rows, staged(tokens, "low-hash-tokens")).select(
        F.xxhash64("lead", part).alias("shard"), F.lit(0).alias("side"), "node", "root"
    )
    return _tree_links(members, sets, percent)


def _prefix_links(sets: DataFrame, roots: DataFrame, percent: int, shard: int) -> DataFrame:
    sketch = _sketch(sets)

    def pick(tokens: np.ndarray) -> np.ndarray:
        often = sketch[(tokens >> np.uint64(64 - _SKETCH)).astype(np.int64)]
        return tokens[np.lexsort((tokens, often))[: _prefix(len(tokens), percent)]]

    rooted = _tokens(sets, pick).join(roots, "node", "left").select("token", "node", F.coalesce("root", "node").alias("root"))
    rows = staged(rooted, "prefix-tokens")
    tokens = rows.groupBy("token").agg(F.min("root").alias("u"), F.max("root").alias("v"), _lead()).where("u != v")
    cells = F.ceil(F.col("size") / shard)
    own = F.pmod(F.xxhash64("node"), cells)
    cell = F.explode(F.sequence(F.lit(0).cast("long"), cells - 1)).alias("cell")
    bundles = _bundles(rows, staged(tokens.select("token", "lead"), "prefix-tokens-across"))
    members = bundles.select("lead", "node", "root", own.alias("own"), cell).select(
        F.xxhash64("lead", F.least("own", "cell"), F.greatest("own", "cell")).alias("shard"),
        (F.col("own") > F.col("cell")).cast("int").alias("side"), "node", "root",
    )
    return _tree_links(members, sets, percent)


def similar(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT, shard: int = SHARD,
) -> DataFrame:
    """``_rf``, ``_ri``, ``id``, ``n_shingles`` and ``component_id`` for each row of ``docs``."""
    slim = keyed(docs).select(*ROW, F.col(f"rec.{id_col}").alias("id"), F.col(f"rec.{text}").alias("text"))
    made = staged(shingled(slim, words, percent), "shingled")
    rows = made.where("owner IS NULL").select(*ROW, "id", "n", "digest")
    nodes = rows.where("n > 0").groupBy("digest").agg(
        F.min("id").alias("low"), F.min(F.struct(*ROW)).alias("first")
    )
    nodes = staged(nodes, "distinct-sets")
    taken = staged(with_partners(made, percent), "sets-with-partners")
    sets = _sets(slim, nodes.join(taken, "digest").select("first.*"), words)
    early = staged(_low_hash_links(sets, percent, shard), "low-hash-links")
    late = _prefix_links(sets, components(early), percent, shard)
    roots = components(early.unionByName(staged(late, "prefix-links")))
    known = sets.select("digest", "node").join(roots, "node").select("digest", "root")
    labelled = staged(nodes.join(known, "digest", "left").select("digest", "low", "root"), "set-roots")
    lowest = labelled.where("root IS NOT NULL").groupBy("root").agg(F.min("low").alias("least"))
    names = staged(labelled.join(staged(lowest, "component-ids"), "root", "left").select(
        "digest", F.when(F.col("root").isNull(), F.col("low")).otherwise(F.col("least")).alias("component_id")
    ), "set-components")
    return rows.join(names, "digest", "left").select(
        *ROW, "id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


_ORACLE = r"""
    with recursive d as (
        select doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
        from documents
    ),
    s as (
        select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                   else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) end) as shingle
        from d
    ),
    sizes as (select doc_id, count(*) as n from s group by doc_id),
    shared as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
    links as (
        select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * o >= 80 * (x.n + y.n - o)
    ),
    ways as (select a, b from links union all select b, a from links),
    reach(doc_id, other) as (
        select doc_id, doc_id from d union select r.doc_id, w.b from reach r join ways w on w.a = r.other
    )
    select r.doc_id, coalesce(any_value(z.n), 0)::bigint as n_shingles, min(other) as component_id
    from reach r left join sizes z on z.doc_id = r.doc_id group by r.doc_id
"""


@query("op12_jaccard_join", _ORACLE)
def op12_jaccard_join(spark, sf_dir):
    return similar(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
