r"""Operator 3: exact duplicates by an exchange of Golomb-coded fingerprints.

1. One pass over the texts writes slim rows: identity, id, code points, SHA-256 and a
   64-bit fingerprint of the text without white space.
2. Each partition of these rows sorts its distinct fingerprints, cut to log2(rows) + 12
   bits, and sends each owner its range of them as one Golomb-Rice coded message. A
   fingerprint that a thousand copies share is one entry of a partition's message.
3. Owners decode, and answer each message with a bitmap: which of its entries occur more
   than once. Senders read the bitmaps against their own messages.
4. Only rows with such a fingerprint are suspects; their texts alone are grouped byte by
   byte (equal texts combine before the shuffle, so a huge group of copies sends one row
   from each partition). Groups of one were false alarms.
5. The row that stays is found on the slim rows.

Exchange messages are bounded by rows / owners, and the number of owners follows the
number of rows. Nothing is broadcast but what the planner finds below its threshold.

Equal: identical after deleting every character of ``[\x20\x09-\x0D]``. The row with the
most code points stays, then the smallest id; of rows that tie in both (repeated rows)
the first in storage, and null ids come last. Null counts as empty; all-blank texts are
equal to each other. Columns of any name pass. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm import golomb
from demandspark.llm.common import ROW, arrow_stage, keyed, partition_count, stored, table, text_stage, without
from demandspark.llm.registry import query
from demandspark.staging import staged

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_ENTRIES_OF_OWNER = 1 << 20
_SPARE_BITS = 12  # a distinct text is a false suspect about once in 2^12


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Slim rows: identity, ``id``, ``chars``, ``sha`` (binary) and ``fp`` (64 bits of it)."""

    def work(texts):
        raw = [(t or "").encode() for t in texts]
        digests = [hashlib.sha256(r.translate(None, SPACES)).digest() for r in raw]
        return {
            "chars": [len(t or "") for t in texts],
            "sha": digests,
            "fp": [int.from_bytes(d[:8], "big", signed=True) for d in digests],
        }

    slim = keyed(docs).select(*ROW, F.col(f"rec.{id_col}").alias("id"), F.col(f"rec.{text}").alias("text"))
    return text_stage(slim, "text", "chars long, sha binary, fp long", lambda: work)


def _messages(prints: DataFrame, bits: int, owner_bits: int) -> DataFrame:
    """One row for each (partition, owner): its sorted distinct fingerprints, Golomb-Rice coded."""
    inner = bits - owner_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column("fp").to_numpy().view(np.uint64) >> np.uint64(64 - bits) for b in batches]
        if not parts:
            return
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        owners = (values >> np.uint64(inner)).astype(np.int64)
        low = values & np.uint64((1 << inner) - 1)
        at = np.flatnonzero(np.diff(owners, prepend=-1))
        rows = []
        for a, b in zip(at, [*at[1:], len(values)]):
            k, unary, remainders = golomb.encode(low[a:b], inner)
            again = np.packbits(counts[a:b] > 1).tobytes()
            rows.append((int(owners[a]), b - a, k, unary, remainders, again))
        sender = TaskContext.get().partitionId()
        owner, n, k, unary, remainders, again = zip(*rows)
        yield pa.RecordBatch.from_pydict({
            "owner": pa.array(owner, pa.int64()), "sender": pa.array([sender] * len(rows), pa.int64()),
            "n": pa.array(n, pa.int64()), "k": pa.array(k, pa.int64()),
            "unary": pa.array(unary, pa.binary()), "remainders": pa.array(remainders, pa.binary()),
            "again": pa.array(again, pa.binary()),
        })

    return arrow_stage(
        prints.select("fp"), run, "owner long, sender long, n long, k long, unary binary, remainders binary, again binary"
    )


def _bitmaps(messages: list[dict]) -> list[tuple[int, int, bytes]]:
    """An owner's answers (owner, sender, bitmap): which entries occur more than once in all."""
    values = [golomb.decode(m["n"], m["k"], m["unary"], m["remainders"]) for m in messages]
    local = [np.unpackbits(np.frombuffer(m["again"], np.uint8), count=m["n"]).astype(bool) for m in messages]
    found, counts = np.unique(np.concatenate(values), return_counts=True)
    many = counts > 1
    many[np.searchsorted(found, np.concatenate([v[x] for v, x in zip(values, local)]))] = True
    bitmaps = [many[np.searchsorted(found, v)] for v in values]
    return [(m["owner"], m["sender"], np.packbits(b).tobytes()) for m, b in zip(messages, bitmaps) if b.any()]


def _answers(sent: DataFrame) -> DataFrame:
    """(owner, sender, bitmap) for each message with a repeated entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        for _, messages in groupby(rows, key=itemgetter("owner")):
            if found := _bitmaps(list(messages)):
                owner, sender, bitmap = zip(*found)
                yield pa.RecordBatch.from_pydict({
                    "owner": pa.array(owner, pa.int64()), "sender": pa.array(sender, pa.int64()),
                    "bitmap": pa.array(bitmap, pa.binary()),
                })

    dealt = sent.repartition(partition_count(sent.sparkSession), "owner").sortWithinPartitions("owner", "sender")
    return arrow_stage(dealt, run, "owner long, sender long, bitmap binary")


def _repeated(inner: int):
    """Senders: the fingerprints of their messages that the bitmaps name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                values = golomb.decode(r["n"], r["k"], r["unary"], r["remainders"])
                named = np.unpackbits(np.frombuffer(r["bitmap"], np.uint8), count=r["n"]).astype(bool)
                short = values[named].astype(np.int64) + (r["owner"] << inner)
                yield pa.RecordBatch.from_pydict({"short": pa.array(short, pa.int64())})

    return run


def suspects(prints: DataFrame) -> DataFrame:
    """Rows of ``prints`` (staged) whose shortened fingerprint occurs more than once."""
    rows = prints.count()
    bits = min(62, math.ceil(math.log2(rows + 1)) + _SPARE_BITS)
    owners = max(partition_count(prints.sparkSession), rows // _ENTRIES_OF_OWNER)
    owner_bits = min(bits - 1, max(1, math.ceil(math.log2(owners))))
    sent = staged(_messages(prints, bits, owner_bits), "fingerprint-messages")
    answers = staged(_answers(sent), "fingerprint-bitmaps")
    named = (
        arrow_stage(sent.join(answers, ["owner", "sender"]), _repeated(bits - owner_bits), "short long").distinct()
    )
    short = F.shiftrightunsigned("fp", 64 - bits)
    return prints.withColumn("short", short).join(staged(named, "repeated-fingerprints"), "short", "left_semi")


def duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``_rf``, ``_ri``, ``id``, ``keep_id``, ``group_size``, ``kept`` and ``sha`` for each row of ``docs``."""
    docs = stored(docs)
    prints = staged(fingerprints(docs, id_col, text), "fingerprints")
    alike = staged(suspects(prints).select(*ROW, "id", "chars", "sha"), "suspects")

    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]", "")
    same = (
        keyed(docs).select(*ROW, F.col(f"rec.{text}").alias("text")).join(alike.select(*ROW), ROW, "left_semi")
        .groupBy(bare.alias("bare")).agg(F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    groups = staged(same.select(F.unhex(F.sha2("bare", 256)).alias("sha"), "group_size"), "verified-groups")
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("u"), "id", *ROW))
    stays = (
        alike.groupBy("sha").agg(best.alias("best"))
        .select("sha", F.col("best.id").alias("keep_id"), *[F.col(f"best.{c}").alias(f"keep{c}") for c in ROW])
    )
    found = staged(stays.join(groups, "sha"), "kept-rows")
    return prints.join(found, "sha", "left").select(
        *ROW, "id",
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | ((F.col("keep_rf") == F.col("_rf")) & (F.col("keep_ri") == F.col("_ri")))).alias("kept"),
        "sha",
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts; same columns."""
    docs = stored(docs)
    return without(docs, staged(duplicates(docs).where("NOT kept").select(*ROW), "dropped-copies"))


@query(
    "op3_exact_dedup",
    r"""
    with d as (
        select doc_id, length(coalesce(text, '')) as n,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
        from documents
    ),
    g as (
        select *, first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id) as keep_id,
               count(*) over (partition by text_sha256) as group_size
        from d
    )
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from g
    """,
)
def op3_exact_dedup(spark, sf_dir):
    return duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )
