"""Operator 11: Merkle dataset manifest by time-forward processing.

Every row is a leaf, the leaves of a tree (one for each value of a column) ascend by an
order column, every two consecutive nodes become their hash up to the tree's subroot, and
the subroots in turn become the root. A proof lists what hashing a leaf up to the root needs.

1. Leaves are hashed where they are read; slim rows (order key, digest) are staged.
2. Positions: a range sort by (tree, order, digest, place), then counts of each partition.
3. Forward sweeps: nodes are labelled (tree, level, index). A digest is a message to its
   parent's label. Messages between blocks of ``2 ** HEIGHT`` nodes travel through Spark's
   external sort, dealt by block and ordered by label; those within a block wait in a heap
   ordered by label and are popped when the sweep reaches the parent. A sweep lifts each
   block by HEIGHT levels, so a table of n rows takes log2(n) / HEIGHT sweeps and no task
   holds more than a block, however many rows one tree has.
4. Reversed sweeps: a block's proof suffix (from its top node to the root) arrives as the
   first row of the block, and is delivered from parents to children down to the leaves.

Defined cases: a null field hashes as ``-``; a null order key sorts first; rows of equal
order key ascend by digest, equal rows (same digest) by where they are stored, and each
has its own proof; a null tree value is a tree of its own and the first of all; a tree of one
leaf has that leaf as subroot; an empty table gives an empty table, no root. Texts
of any length are hashed whole. Only the named columns are read, so further columns of any
name do no harm; the result's columns are the operator's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from demandspark.llm.common import arrow_stage, partition_count, table
from demandspark.llm.registry import query
from demandspark.staging import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEIGHT = 12
ALONE = "."
_OUT_ROWS = 4096


def leaf_digest(fields: list[Column]) -> Column:
    """Hex SHA-256 of the fields: ``-`` if null, else UTF-8 byte count, ``:``, value."""

    def part(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(f) for f in fields]), 256)


def _placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` (staged, of few columns) with ``at``, the place within ``tree`` by ``order``, and ``total``."""
    n = partition_count(rows.sparkSession)
    ordered = rows.repartitionByRange(n, "tree", *order).sortWithinPartitions("tree", *order)
    numbered = staged(ordered.withColumn("spot", F.monotonically_increasing_id()), "sorted-nodes")
    numbered = numbered.withColumn("part", F.shiftright("spot", 33))
    # A tree has at most one run in each partition.
    runs = numbered.groupBy("tree", "part").agg(F.min("spot").alias("first"), F.count("*").alias("size"))
    of_tree = Window.partitionBy("tree")
    before = F.sum("size").over(of_tree.orderBy("part")) - F.col("size")
    runs = runs.select("tree", "part", "first", before.alias("before"), F.sum("size").over(of_tree).alias("total"))
    return numbered.join(staged(runs, "runs"), ["tree", "part"]).select(
        *rows.columns, (F.col("before") + F.col("spot") - F.col("first")).alias("at"), "total"
    )


def _hash(digests: list[bytes]) -> bytes:
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def levels_of(nodes: int, most: int) -> int:
    """Levels from ``nodes`` consecutive nodes to their top, ``most`` at most."""
    return min(most, (nodes - 1).bit_length())


def sweep(digests: list[bytes], levels: int) -> list[list[bytes]]:
    """Digests of all nodes of a block, level by level; children send theirs to the parent's label."""
    made = [list(digests)]
    if not levels:
        return made
    made += [[] for _ in range(levels)]
    queue = [(1, i >> 1, i & 1, d) for i, d in enumerate(digests)]  # ordered, hence a heap
    while queue:
        level, at, _, digest = heappop(queue)
        children = [digest]
        while queue and queue[0][:2] == (level, at):
            children.append(heappop(queue)[3])
        made[level].append(_hash(children))
        if level < levels:
            heappush(queue, (level + 1, at >> 1, at & 1, made[level][-1]))
    return made


def suffixes(made: list[list[bytes]], top: str) -> list[str]:
    """The proof of each node of the lowest level, given that of the top node: the sweep reversed."""
    down = [top]
    for nodes in reversed(made[:-1]):
        entries = [ALONE if i ^ 1 >= len(nodes) else ("L" if i & 1 else "R") + nodes[i ^ 1].hex() for i in range(len(nodes))]
        down = [f"{e},{down[i >> 1]}" for i, e in enumerate(entries)]
    return down


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one (tree, block) after the other, from input sorted by them."""
    held, name = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = row["tree"], row["block"]
            if held and key != name:
                yield held
                held = []
            name = key
            held.append(row)
    if held:
        yield held


def _forward(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []

        def flushed():
            tree, at, total, digest = zip(*out)
            return pa.RecordBatch.from_pydict({
                "tree": pa.array(tree, pa.string()), "at": pa.array(at, pa.int64()),
                "total": pa.array(total, pa.int64()), "digest": pa.array(digest, pa.binary()),
            })

        for rows in _blocks(batches):
            total = rows[0]["total"]
            top = sweep([r["digest"] for r in rows], levels_of(total, height))[-1][0]
            out.append((rows[0]["tree"], rows[0]["block"], -(-total >> height), top))
            if len(out) >= _OUT_ROWS:
                yield flushed()
                out = []
        if out:
            yield flushed()

    return run


def _dealt(rows: DataFrame) -> DataFrame:
    n = partition_count(rows.sparkSession)
    return rows.repartition(n, "tree", "block").sortWithinPartitions("tree", "block", "at")


def _lifted(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Staged node tables of all sweeps, the last with one node a tree."""
    sweeps = [nodes]
    while (sweeps[-1].agg(F.max("total")).first()[0] or 0) > 1:
        rows = sweeps[-1].select("tree", "at", "total", "digest", F.shiftright("at", height).alias("block"))
        up = arrow_stage(_dealt(rows), _forward(height), "tree string, at long, total long, digest binary")
        sweeps.append(staged(up, "merkle-nodes"))
    return sweeps


def _backward(height: int, load: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (message, *rows) in _blocks(batches):  # the suffix sorts before all nodes
            made = sweep([r["digest"] for r in rows], levels_of(rows[0]["total"], height))
            down = suffixes(made, message["suffix"])
            for a in range(0, len(rows), _OUT_ROWS):
                part = rows[a : a + _OUT_ROWS]
                yield pa.RecordBatch.from_pydict({
                    "tree": pa.array([r["tree"] for r in part], pa.string()),
                    "at": pa.array([r["at"] for r in part], pa.int64()),
                    "digest": pa.array([r["digest"] for r in part], pa.binary()),
                    "top": pa.array([message["digest"]] * len(part), pa.binary()),
                    "suffix": pa.array(down[a : a + _OUT_ROWS], pa.string()),
                    "load": pa.array([r["load"] for r in part], load),
                })

    return run


def _lowered(sweeps: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """``tree, at, digest, top, suffix, load`` of the first sweep's nodes (``load`` is theirs).

    ``tops`` has the subroot (``digest``) of each tree and the proof ``suffix`` above it.
    """
    field = sweeps[0].schema["load"]
    empty = F.lit(None).cast(field.dataType).alias("load")
    down = tops.select("tree", F.lit(0).cast("long").alias("at"), F.col("digest").alias("top"), "suffix")
    if len(sweeps) == 1:  # no tree, or single leaves alone
        return sweeps[0].select("tree", "at", "digest", "load").join(down.drop("at"), "tree").select(
            "tree", "at", "digest", "top", "suffix", "load"
        )
    schema = T.StructType([*T._parse_datatype_string(
        "tree string, at long, digest binary, top binary, suffix string"
    ).fields, T.StructField("load", field.dataType)])
    run = _backward(height, to_arrow_type(field.dataType))
    for i in range(len(sweeps) - 2, -1, -1):
        rows = sweeps[i].select(
            "tree", F.shiftright("at", height).alias("block"), "at", "total", "digest",
            F.lit(None).cast("string").alias("suffix"), empty if i else "load",
        ).unionByName(down.select(
            "tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"),
            F.lit(None).cast("long").alias("total"), F.col("top").alias("digest"), "suffix", empty,
        ))
        down = arrow_stage(_dealt(rows), run, schema)
        if i:
            down = staged(down, "merkle-suffixes")
    return down


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, order: str = "doc_id", tree: str = "lang",
    keep: Column | None = None, height: int = HEIGHT,
) -> DataFrame:
    """``id``, ``leaf``, ``subroot``, ``root`` (hex), ``proof`` and ``keep`` for each row of ``docs``.

    ``proof`` has one entry for each level, from the leaf up: ``L`` or ``R`` and the sibling's
    digest (it stands left or right), or ``.`` where the node is hashed alone; each entry ends
    with a comma. ``keep`` is any column over ``docs`` to be carried along.
    """
    label = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    load = F.struct(F.col(order).alias("id"), (F.lit(None).cast("string") if keep is None else keep).alias("keep"))
    leaves = docs.select(label.alias("tree"), F.unhex(leaf_digest([F.col(f) for f in fields])).alias("digest"), load.alias("load"))
    leaves = staged(leaves.withColumn("place", F.monotonically_increasing_id()), "leaves")
    sweeps = _lifted(staged(_placed(leaves, "load.id", "digest", "place"), "leaf-nodes"), height)
    subroots = staged(sweeps[-1].select(F.lit("").alias("tree"), "digest", F.col("tree").alias("load")), "subroots")
    above = _lifted(staged(_placed(subroots, "load"), "subroot-nodes"), height)
    root = above[-1].first()
    tops = _lowered(above, above[-1].select("tree", "digest", F.lit("").alias("suffix")), height)
    tops = staged(tops.select(F.col("load").alias("tree"), "digest", "suffix"), "tops")
    return _lowered(sweeps, tops, height).select(
        F.col("load.id").alias("id"), F.lower(F.hex("digest")).alias("leaf"), F.lower(F.hex("top")).alias("subroot"),
        F.lit(root and root["digest"].hex()).cast("string").alias("root"), F.col("suffix").alias("proof"),
        F.col("load.keep").alias("keep"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""

    def step(digest: Column, entry: Column) -> Column:
        other = F.substring(entry, 2, 64)
        both = F.when(entry == ALONE, digest).when(F.startswith(entry, F.lit("L")), F.concat(other, digest))
        return F.sha2(both.otherwise(F.concat(digest, other)), 256)

    return F.aggregate(F.filter(F.split(proof, ","), lambda e: e != ""), leaf, step)


def siblings_digest(proof: Column) -> Column:
    """Hex SHA-256 of the digests in a proof, in order."""
    return F.sha2(F.translate(proof, "LR.,", ""), 256)


_ORACLE = r"""
    with recursive d as (
        select *, coalesce('=' || lang, '') as tree, row_number() over (partition by lang order by doc_id nulls first) - 1 as i,
               count(*) over (partition by lang) as n,
               xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::ubigint)),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::ubigint)),
                       lambda x, z: xor(x >> 1, 3988292384::ubigint * (x & 1)))), 4294967295::ubigint) % 7 = 0 as hit
        from documents
    ),
    f as (
        select doc_id, tree, i, n, hit,
               coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') as head,
               n_chars, coalesce(strlen(text) || ':' || text, '-') as tail
        from d
    ),
    leaves as (
        select doc_id, tree, i, n, sha256(head || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') || tail) as leaf,
               case when hit then sha256(head || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-') || tail) end as changed
        from f
    ),
    nodes(tree, level, i, n, h) as (
        select tree, 0, i, n, leaf from leaves
        union all
        select tree, level + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by i))
        from nodes where n > 1 group by tree, level, i // 2
    ),
    subroots as (
        select tree, level, h as subroot, row_number() over (order by tree) - 1 as i, count(*) over () as n from nodes where n = 1
    ),
    above(level, i, n, h) as (
        select 0, i, n, subroot from subroots
        union all
        select level + 1, i // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by i))
        from above where n > 1 group by level, i // 2
    ),
    steps as (
        select l.doc_id, k.level, (l.i >> k.level) & 1 as side, s.h
        from leaves l join subroots r using (tree), lateral (select unnest(range(r.level))::int as level) k
        left join nodes s on s.tree = l.tree and s.level = k.level and s.i = xor(l.i >> k.level, 1)
        union all
        select l.doc_id, r.level + k.level, (r.i >> k.level) & 1, s.h
        from leaves l join subroots r using (tree), lateral (select unnest(range((select max(level) from above)))::int as level) k
        left join above s on s.level = k.level and s.i = xor(r.i >> k.level, 1)
    ),
    folds(doc_id, level, acc) as (
        select doc_id, 0, coalesce(changed, leaf) from leaves
        union all
        select f.doc_id, f.level + 1, sha256(case when s.h is null then acc when side = 1 then s.h || acc else acc || s.h end)
        from folds f join steps s on s.doc_id = f.doc_id and s.level = f.level
    ),
    proofs as (select doc_id, sha256(coalesce(string_agg(h, '' order by level), '')) as proof_sha256 from steps group by doc_id),
    ends as (select doc_id, max_by(acc, level) as folded_root from folds group by doc_id),
    top as (select h as root from above where n = 1)
    select l.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
    from leaves l join subroots using (tree) join ends using (doc_id) left join proofs using (doc_id), top
"""


@query("op11_merkle_manifest", _ORACLE)
def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    changed = [F.col(f) if f != "n_chars" else F.col(f).cast("decimal(20,0)") + 1 for f in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = manifest(docs, keep=F.when(hit, leaf_digest(changed)))
    out = found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", siblings_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.coalesce("keep", "leaf"), F.col("proof")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
