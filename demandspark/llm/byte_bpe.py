"""Operator 5: byte-level BPE encoding and decoding.

``encode`` cuts texts into pre-tokens by ``pretokens`` (array scans, no regular
expression) and looks each up in a cache of finished merges; only an unseen pre-token is
merged. Token offsets are kept beside the ids, so ``decode`` places every token's bytes
by array arithmetic and can also cut out any token range.

Both are narrow stages: no shuffle, no state but a cache of bounded size in each worker.

Defined cases: null text counts as empty; an empty text has no ids; ids and other columns
pass as they are, null or repeated; a column of a new column's name is replaced; an empty
table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandspark.llm.common import Cache, arrow_stage, table, text_function
from demandspark.llm.pretokens import split
from demandspark.llm.registry import query

CACHE_ENTRIES = 200_000
_CACHED_CHARS = 64  # longer pre-tokens are merged anew each time


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merger(ranks: dict[bytes, int], entries: int = CACHE_ENTRIES) -> Cache:
    """Pre-token to its ids as little-endian unsigned 32-bit integers."""
    import tiktoken

    core = tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    merge = core._encode_single_piece
    return Cache(lambda piece: np.array(merge(piece.encode()), "<u4").tobytes(), entries, _CACHED_CHARS)


def encode_function(fields: T.StructType, ranks_path: str, text: str = "text"):
    """Arrow function from texts to ``ids`` and ``offsets``."""

    def make():
        ranks = read_ranks(ranks_path)
        lengths = np.zeros(max(ranks.values(), default=0) + 1, np.uint32)
        lengths[list(ranks.values())] = [len(t) for t in ranks]
        merged = merger(ranks)

        def work(texts):
            ids = [b"".join(map(merged.__getitem__, pieces)) for pieces, _ in split([t or "" for t in texts])]
            ends = [np.cumsum(lengths[np.frombuffer(x, "<u4")], dtype="<u4").tobytes() for x in ids]
            return {"ids": ids, "offsets": ends}

        return work

    return text_function(fields, text, "ids binary, offsets binary", make)


def decode_function(fields: T.StructType, ranks_path: str):
    """Arrow function that adds ``decoded`` to rows with ``ids`` and ``offsets``."""
    schema = T.StructType([*[f for f in fields.fields if f.name != "decoded"], T.StructField("decoded", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(ranks_path)
        tokens = sorted(ranks, key=ranks.get)
        flat = np.frombuffer(b"".join(tokens), np.uint8)
        begins = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        begins[[ranks[t] for t in tokens]] = np.cumsum([0] + [len(t) for t in tokens[:-1]])

        def text_of(ids: bytes | None, offsets: bytes | None) -> bytes:
            if not ids:
                return b""
            at = begins[np.frombuffer(ids, "<u4")]
            ends = np.frombuffer(offsets, "<u4").astype(np.int64)
            starts = np.concatenate([[0], ends[:-1]])
            return flat[np.arange(ends[-1]) + np.repeat(at - starts, ends - starts)].tobytes()

        for batch in batches:
            texts = map(text_of, batch.column("ids").to_pylist(), batch.column("offsets").to_pylist())
            yield pa.RecordBatch.from_arrays([*map(batch.column, arrow.names[:-1]), pa.array(list(texts), pa.binary())], schema=arrow)

    return run, schema


def encode(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``ids`` and ``offsets``.

    Both are binary, one little-endian unsigned 32-bit integer per token: its rank, and the
    end of its bytes in the text's UTF-8 form.
    """
    return arrow_stage(docs, *encode_function(docs.schema, ranks_path, text))


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded``, which has the columns that ``encode`` adds, with ``decoded`` (binary)."""
    return arrow_stage(encoded, *decode_function(encoded.schema, ranks_path))


def round_trip(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``decode`` of ``encode``, both in one Python worker."""
    there, fields = encode_function(docs.schema, ranks_path, text)
    back, schema = decode_function(fields, ranks_path)
    return arrow_stage(docs, lambda batches: back(there(batches)), schema)


@query("op5_byte_bpe")
def op5_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
