import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from demandspark.llm import packing


def check(pieces, lengths, capacity=packing.CAPACITY):
    """Every sequence is gapless and within the capacity; returns the share of padding."""
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        total += at
        padding += capacity - at
    assert total == sum(lengths)
    return padding / max(total, 1)


def test_every_id_lies_in_one_piece(spark, odd, odd_documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.packed_documents(spark.read.parquet(f"{odd}/documents.parquet")).collect()
    wanted = defaultdict(list)
    for doc_id, text, *_ in odd_documents:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END]
        wanted[doc_id].append(np.array(ids, "<u4").tobytes())
    check(rows, [len(x) // 4 for v in wanted.values() for x in v])
    for doc_id, texts in wanted.items():
        mine = [r for r in rows if r["doc_id"] == doc_id]
        assert sum(r["length"] for r in mine) == sum(len(x) // 4 for x in texts)
        for r in mine:
            assert any(
                len(x) // 4 == r["doc_tokens"] and x[4 * r["start"] : 4 * (r["start"] + r["length"])] == bytes(r["ids"])
                for x in texts
            )


def test_digest_query(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    full = {(r["sequence_id"], r["offset"]): zlib.crc32(bytes(r["ids"])) for r in packing.packed_documents(docs).collect()}
    rows = packing.op2_packing(spark, odd).collect()
    assert {(r["sequence_id"], r["offset"]): r["ids_crc32"] for r in rows} == full


@pytest.mark.parametrize("capacity", [8, 16, 100, 4096])
def test_bins_hold_fixed_counts_and_little_padding(capacity):
    rng = np.random.default_rng(3)
    bins, rows = packing.Bins(capacity, 0), []
    lengths = rng.integers(1, 3 * capacity, 4000)
    for doc, n in enumerate(lengths):
        rows += bins.add(doc, np.arange(n, dtype="<u4").tobytes())
    for closed in bins.rest():
        rows += closed
    names = "doc start length ids tokens sequence_id offset".split()
    pieces = [dict(zip(names, r)) for r in rows]
    covered = defaultdict(list)
    for p in pieces:
        assert np.frombuffer(p["ids"], "<u4").tolist() == list(range(p["start"], p["start"] + p["length"]))
        covered[p["doc"]] += range(p["start"], p["start"] + p["length"])
    assert all(sorted(covered[d]) == list(range(n)) for d, n in enumerate(lengths))
    assert check(pieces, lengths, capacity) < 0.05


def test_padding_on_documents(spark):
    rows = packing.op2_packing(spark, "/root/testdata/sf0.01").collect()
    assert check(rows, [r["length"] for r in rows]) < 0.02


def test_empty_table_and_clashing_names(spark, empty, clashing):
    assert packing.op2_packing(spark, empty).count() == 0
    assert packing.packed_documents(clashing).count() > 0
