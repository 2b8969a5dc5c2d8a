r"""Operator 4: near duplicates by SimHash and sharded BK-trees.

1. One pass over the texts gives each row a 64-bit fingerprint of its word shingles.
   Rows of equal fingerprint are one node from here on (a huge group combines map-side).
2. Shards: 64 bits are cut into five blocks; fingerprints that differ in at most three
   bits agree in two whole blocks, so each is dealt to the ten shards that its pairs of
   blocks name, and every linked pair meets in one. Shards of one are dropped.
3. Each shard is a BK-tree: children are keyed by integer Hamming distance, a search
   follows only edges within the radius. A shard above ``SHARD_NODES`` is cut into several
   trees, and its fingerprints visit each of them; trees and visitors are spread over all
   tasks, so no shard is bound to one task.
4. A task reduces the links of a shard to a spanning forest: no group is written out as
   pairs, and no link between different fingerprints is lost.
5. Components of the forest, labelled by the smallest id.

Words are ``[^\x20\x09-\x0D]+`` after lower-casing A-Z; shingles are runs of three words
joined by spaces, repeats included (fewer words: all of them; none: fingerprint zero,
linked like any other). A bit is set if it is set in over half of the shingles' XXH64
(UTF-8, seed 42).

Defined cases: null text counts as empty; null ids come last when the smallest is chosen
(a component of null ids alone has a null id); repeated rows share a component; an empty
table gives an empty table; columns of any name pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.bk_trees import Forest
from demandspark.llm.common import ROW, arrow_stage, keyed, partition_count, stored, table, text_stage, without
from demandspark.llm.components import components
from demandspark.llm.registry import query
from demandspark.staging import staged

RADIUS = 3
SHINGLE = 3
SHARD_NODES = 1 << 12
# (first bit, width) of the five blocks, and the pairs of blocks that name shards.
BLOCKS = [(0, 13), (13, 13), (26, 13), (39, 13), (52, 12)]
TABLES = list(combinations(range(len(BLOCKS)), len(BLOCKS) - RADIUS))
_BATCH = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a text."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = (np.cumsum(lengths) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    if len(words) > shingle:
        ends = ends[shingle - 1 :]
    else:
        ends = ends[-1:]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[a:b], 42) for a, b in zip(starts, ends)], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Slim rows: identity, ``id`` and ``fp``."""
    slim = keyed(docs).select(*ROW, F.col(f"rec.{id_col}").alias("id"), F.col(f"rec.{text}").alias("text"))
    return text_stage(
        slim, "text", "fp long", lambda: lambda texts: {"fp": [fingerprint(t, shingle) for t in texts]}
    )


def _shards(nodes: DataFrame) -> DataFrame:
    """(shard, fp): every fingerprint in the ten shards of its pairs of blocks."""

    def block(i: int):
        first, width = BLOCKS[i]
        return F.shiftrightunsigned("fp", first).bitwiseAND((1 << width) - 1)

    def shard(number: int, pair) -> F.Column:
        a, b = pair
        return F.lit(number << 26) + F.shiftleft(block(a), BLOCKS[b][1]) + block(b)

    names = F.array(*[shard(i, pair) for i, pair in enumerate(TABLES)])
    return nodes.select("fp", F.explode(names).alias("shard"))


def _forest_links(values: np.ndarray, group: np.ndarray, is_query: np.ndarray, radius: int):
    """Spanning forest, as (a, b) values, of the links in trees that ``group`` (sorted) names.

    Rows that are queries visit the tree of their group; the others are its nodes, and visit
    it too.
    """
    in_tree = np.flatnonzero(~is_query)
    forest = Forest(values[in_tree], group[in_tree])
    tree_of, at = np.unique(group, return_inverse=True)
    roots = np.array([forest.root.get(int(g), -1) for g in tree_of])[at]
    asking = np.flatnonzero(roots >= 0)
    label = np.arange(len(values))
    for who, node in forest.search(values[asking], roots[asking], radius):
        a, b = asking[who], in_tree[node]
        while True:  # smaller label wins along the links found so far
            la, lb = label[a], label[b]
            low, high = np.minimum(la, lb), np.maximum(la, lb)
            open_ = low < high
            if not open_.any():
                break
            np.minimum.at(label, high[open_], low[open_])
            while (deeper := label[label] != label).any():
                label = label[label]
    child = np.flatnonzero(label != np.arange(len(values)))
    return values[child], values[label[child]]


def links(nodes: DataFrame, radius: int = RADIUS, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """(a, b): spanning forests of the links among distinct fingerprints ``fp`` (staged)."""
    n = partition_count(nodes.sparkSession)
    sizes = staged(_shards(nodes).groupBy("shard").agg(F.count("*").alias("size")).where("size > 1"), "shards")
    dealt = _shards(nodes).join(sizes, "shard").withColumn("trees", F.ceil(F.col("size") / shard_nodes))
    own = F.pmod(F.xxhash64("fp"), "trees")
    # The tree it stands in, then those it visits: each pair of trees of a shard meets once.
    visits = F.transform(F.sequence(F.lit(0), F.col("trees") - 1), lambda t: F.struct(
        t.alias("tree"), (t != own).alias("asks")
    ))
    rows = dealt.select("fp", "shard", own.alias("own"), F.explode(
        F.filter(visits, lambda v: v["tree"] >= own)
    ).alias("v")).select("fp", "shard", F.col("v.tree").alias("tree"), F.col("v.asks").alias("asks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(part: pa.Table) -> pa.RecordBatch:
            shard, tree = part["shard"].to_numpy(), part["tree"].to_numpy()
            new = np.append(True, (shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1]))
            a, b = _forest_links(
                part["fp"].to_numpy().view(np.uint64), np.cumsum(new) - 1,
                part["asks"].to_numpy(zero_copy_only=False), radius,
            )
            return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if held.num_rows < _BATCH:
                continue
            shard, tree = held["shard"].to_numpy(), held["tree"].to_numpy()
            same = (shard == shard[-1]) & (tree == tree[-1])
            end = int(np.argmax(same))  # the last tree may go on in the next batch
            if end:
                yield found(held.slice(0, end).combine_chunks())
                held = held.slice(end)
        if held is not None and held.num_rows:
            yield found(held.combine_chunks())

    dealt = rows.repartition(n, "shard", "tree").sortWithinPartitions("shard", "tree", "asks")
    return arrow_stage(dealt, run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """``_rf``, ``_ri``, ``id``, ``fp`` and ``component_id`` for each row of ``docs``."""
    prints = staged(fingerprints(docs, id_col, text), "simhashes")
    nodes = staged(prints.groupBy("fp").agg(F.min("id").alias("low")), "simhash-nodes")
    roots = components(links(nodes.select("fp"), radius))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    rooted = staged(rooted, "simhash-roots")
    smallest = staged(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "component-ids")
    labels = staged(rooted.join(smallest, "root").select("fp", "component_id", "root"), "component-labels")
    return prints.join(labels, "fp").select(*ROW, "id", "fp", "component_id", "root")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (nulls last, then the
    first in storage); same columns."""
    docs = stored(docs)
    found = staged(near_duplicates(docs).select(*ROW, "id", "root"), "near-duplicates")
    first = F.min(F.struct(F.col("id").isNull().alias("u"), "id", *ROW)).alias("first")
    stays = staged(found.groupBy("root").agg(first).select("first.*").select(*ROW), "kept-of-component")
    dropped = found.select(*ROW).join(stays, ROW, "left_anti")
    return without(docs, staged(dropped, "dropped-near-duplicates"))


@query("op4_simhash")
def op4_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
