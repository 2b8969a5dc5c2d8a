"""Operator 2: harmonic packing of tokenised documents into training sequences.

A piece of r tokens is of class i = capacity // r, and a bin of class i takes exactly i
pieces: every worker fills its own bins with a fixed count, sees no other worker and keeps
at most one open bin for each class. Documents are cut so that the classes fit: whole
capacities first, then halves, quarters, ... down to a sixteenth, which fill their bins
without a gap; the last piece, below a sixteenth, is of a class of 16 or more and loses
at most a 17th of its bin. What stands in the open bins when a worker's rows end is put
together, cut at the capacity; only the worker's last sequence is short.

One narrow stage without a shuffle. A retried task reads the same rows in the same order
and gives the same bins, with sequence ids that hold its partition number.

Defined cases: null text counts as empty; an empty text has the end token alone; ids pass
as they are, null or repeated (each row is a document of its own); a document of any
length is cut; a column of a new column's name is replaced; an empty table gives an empty
table.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from demandspark.llm.common import Cache, arrow_stage, table, text_function
from demandspark.llm.prefix_counts import byte_letters
from demandspark.llm.registry import query

CAPACITY = 4096
END = 2
_WHOLE_PARTS = 16  # pieces of capacity, 1/2, 1/4, ... 1/16 fill their bins without a gap
CACHE_ENTRIES = 100_000
_CACHED_BYTES = 64
_ROWS_OUT = 4096


# Words of these characters alone (printable ASCII, Latin-1 letters) keep their form under
# NFC and change to lower case letter by letter; their pre-tokens follow from this pattern.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_WORD_END = "</w>"
_END_BYTE = b"\xff"  # stands for the word end; no UTF-8 text has it


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def _merges(path: str):
    """(merge function of a pre-token's bytes with the end byte, packed id of each rank)."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    byte_of = byte_letters()

    def raw(token: str) -> bytes:
        ends = token.endswith(_WORD_END)
        return bytes(byte_of[c] for c in token.removesuffix(_WORD_END)) + _END_BYTE * ends

    order = [c + end for end in ("", _WORD_END) for c in byte_of] + ["".join(m) for m in model["merges"]]
    ranks = {raw(token): i for i, token in enumerate(order)}
    ranks[_END_BYTE] = len(order)  # never left over: joining it to its byte comes first
    core = tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
    return core._encode_single_piece, [struct.pack("<I", model["vocab"][t]) for t in order]


def word_ids(path: str, entries: int = CACHE_ENTRIES) -> Cache:
    """Word (UTF-8 bytes without ASCII white space) to its ids, packed as unsigned 32-bit.

    For tokenizers with word ends that lower-case, drop white space and never look across
    it. Plain words are cut and merged here, by the merge list of the tokenizer's file; all
    others, and words that may hold a special token, go to the library.
    """
    encode = _tokenizer(path).encode
    merge, packed = _merges(path)
    pieces = Cache(
        lambda piece: b"".join(map(packed.__getitem__, merge(piece.encode() + _END_BYTE))), entries, _CACHED_BYTES
    )

    def ids(word: bytes) -> bytes:
        text = word.decode()
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(pieces.__getitem__, _PIECES.findall(text.lower())))
        return np.array(encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return Cache(ids, entries, _CACHED_BYTES)


def token_function(fields: T.StructType, path: str, text: str = "text", end: int = END):
    """Arrow function from texts to ``ids``: packed ids and the end token."""

    def make():
        words = word_ids(path)
        stop = np.array([end], "<u4").tobytes()
        return lambda texts: {
            "ids": [b"".join(map(words.__getitem__, (t or "").encode().split())) + stop for t in texts]
        }

    return text_function(fields, text, "ids binary", make)


def token_ids(docs: DataFrame, path: str, text: str = "text", end: int = END) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``ids``."""
    return arrow_stage(docs, *token_function(docs.schema, path, text, end))


class Bins:
    """The open bins of one worker; a piece is (document, start, ids as bytes, document's tokens)."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[tuple]] = {}

    def cut(self, tokens: int) -> Iterator[tuple[int, int]]:
        """(start, length) of the pieces of a document."""
        at, part = 0, self.capacity
        while part * _WHOLE_PARTS >= self.capacity and at < tokens:
            while tokens - at >= part:
                yield at, part
                at += part
            part //= 2
        if at < tokens:
            yield at, tokens - at

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        rows, offset = [], 0
        for doc, start, ids, tokens in pieces:
            rows.append((doc, start, len(ids) // 4, ids, tokens, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1
        return rows

    def add(self, doc, ids: bytes) -> list[tuple]:
        """Rows of the bins that this document closes."""
        rows, tokens = [], len(ids) // 4
        for start, length in self.cut(tokens):
            kind = self.capacity // length
            pieces = self.open.setdefault(kind, [])
            pieces.append((doc, start, ids[4 * start : 4 * (start + length)], tokens))
            if len(pieces) == kind:
                rows += self._close(self.open.pop(kind))
        return rows

    def rest(self) -> Iterator[list[tuple]]:
        """Rows of what stands in open bins, cut at the capacity."""
        bin_, room = [], self.capacity
        for kind in sorted(self.open):
            for doc, start, ids, tokens in self.open[kind]:
                while ids:
                    part, ids = ids[: 4 * room], ids[4 * room :]
                    bin_.append((doc, start, part, tokens))
                    start, room = start + len(part) // 4, room - len(part) // 4
                    if not room:
                        yield self._close(bin_)
                        bin_, room = [], self.capacity
        if bin_:
            yield self._close(bin_)


def pack_function(fields: T.StructType, capacity: int = CAPACITY):
    """Arrow function from an id column and ``ids`` to the pieces of the sequences."""
    (key,) = [f for f in fields.fields if f.name != "ids"]
    schema = T.StructType([key, *T._parse_datatype_string(
        "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    ).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, TaskContext.get().partitionId() << 33)

        def batch_of(rows):
            columns = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, arrow.types)], schema=arrow
            )

        rows: list[tuple] = []
        for batch in batches:
            for doc, ids in zip(batch.column(key.name).to_pylist(), batch.column("ids")):
                rows += bins.add(doc, ids.as_py() or b"")
                if len(rows) >= _ROWS_OUT:
                    yield batch_of(rows)
                    rows = []
        for closed in bins.rest():
            rows += closed
            if len(rows) >= _ROWS_OUT:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    return run, schema


def pack(tokens: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the documents of ``tokens`` (an id column and ``ids``) in sequences.

    Columns: the id column, start, length, ids, doc_tokens, sequence_id, offset.
    """
    return arrow_stage(tokens, *pack_function(tokens.schema, capacity))


def packed_documents(docs: DataFrame) -> DataFrame:
    """Documents tokenised and packed by the production parameters, ids included.

    Both steps run in one Python worker, document by document.
    """
    import public_tokenizers

    slim = docs.select("doc_id", "text")
    tokens, fields = token_function(slim.schema, public_tokenizers.path("word_bpe_49k.json"))
    pieces, schema = pack_function(fields)
    return arrow_stage(slim, lambda batches: pieces(tokens(batches)), schema)


@query("op2_packing")
def op2_packing(spark, sf_dir):
    return packed_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
