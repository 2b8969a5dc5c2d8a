r"""Operator 8: WARC archives, written by Spark and read back by a splittable reader.

Writing: every record is one gzip member. Spark's text writer stores the members of a
partition in one file through whatever file system the path names; the separator it must
put after each row is an empty gzip member, so the file is a plain multi-member archive.

Reading: tasks scan byte ranges. Spark's text reader with the gzip magic as separator cuts
each range at every occurrence of the magic, and gives a task the pieces that start inside
its range, read to their end. A piece is taken for a member only if it decodes to WARC
header lines (or is an empty member); the magic also occurs by chance inside compressed
data, so a piece that cannot begin a member continues the one before it. Where that one
began in the range before, both sides are handed over as fragments, and a small shuffle by
file joins them; so are the pieces of a member that the magic cuts before its first bytes
decode. Fragments that make no whole members are an error. File names must not end in
``.gz`` (the reader would unpack them whole).

Of records with equal payloads of at least 1000 bytes, that with the largest page id is
the response, others are revisits without a payload, which name it. Null ids come last;
of rows that tie (repeated rows) the first in storage is the response.

Defined cases: null html counts as empty; a null url is written empty; a null page id is
written empty and read as null; an empty table gives an empty archive; columns of any other name do no harm.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandspark.llm.common import ROW, arrow_stage, keyed, table
from demandspark.llm.registry import query
from demandspark.staging import staged, staging_path

MAGIC = b"\x1f\x8b\x08"
REVISIT_BYTES = 1000
_DATE = "1970-01-01T00:00:00Z"  # the tables hold no fetch time
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_PROBE_BYTES = 64
RECORD = "record_type string, record_id string, uri string, refers_to_id string, digest string, payload_bytes long, payload binary"
FRAGMENT = "file string, block long, seq long, piece binary"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(3, wbits=31)
    return packer.compress(data) + packer.flush()


EMPTY_MEMBER = member(b"")


def record_bytes(page, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page)}",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}", f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {_PROFILE}"] if revisit else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(lines: bytes) -> dict[str, str]:
    return {
        k.strip().lower(): v.strip()
        for k, sep, v in (x.partition(":") for x in lines.decode("utf-8", "replace").split("\r\n")[1:]) if sep
    }


def parse_record(data: bytes) -> tuple:
    """Columns of RECORD from an unpacked member; the digest of a response is taken of its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    if kind == "revisit":
        size = int(_fields(http)["content-length"])
        digest = fields["warc-payload-digest"].removeprefix("sha1:")
        return kind, fields["warc-record-id"], fields["warc-target-uri"], fields["warc-refers-to"], digest, size, None
    return (
        kind, fields["warc-record-id"], fields["warc-target-uri"], None,
        hashlib.sha1(payload).hexdigest(), len(payload), payload,
    )


class Members:
    """Puts the pieces of one byte range together to members."""

    def __init__(self):
        self.unpacker, self.data, self.raw = None, [], []

    def _begins(self, piece: bytes) -> bool:
        """Whether a member begins here: an empty one, or one that decodes to a WARC header."""
        probe = zlib.decompressobj(31)
        try:
            head = probe.decompress(piece, _PROBE_BYTES)
        except zlib.error:
            return False
        return head.startswith(b"WARC/") or not head and probe.eof

    def add(self, piece: bytes) -> tuple[str, bytes | None]:
        """('record', unpacked bytes), ('open', None) or ('loose', None) for a piece that begins no member."""
        if self.unpacker is None:
            if not self._begins(piece):
                return "loose", None
            self.unpacker, self.data, self.raw = zlib.decompressobj(31), [], []
        self.raw.append(piece)
        self.data.append(self.unpacker.decompress(piece))
        if not self.unpacker.eof:
            return "open", None
        self.unpacker = None
        return "record", b"".join(self.data)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write a record for each row of ``pages`` to files under ``path``."""
    slim = keyed(pages).select(
        *ROW, F.col(f"rec.{id_col}").alias("id"), F.col(f"rec.{url}").alias("url"),
        F.encode(F.coalesce(f"rec.{html}", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    # Largest id first, nulls last, then the first in storage: the largest struct has the smallest place.
    rank = F.struct(F.col("id").isNotNull().alias("k"), "id", (-F.col("_ri")).alias("i"), (-F.col("_rf")).alias("f"))
    groups = (
        slim.where(F.octet_length("payload") >= REVISIT_BYTES)
        .select("digest", F.octet_length("payload").alias("size"), rank.alias("rank"))
        .groupBy("digest", "size").agg(F.count("*").alias("n"), F.max("rank").alias("best")).where("n > 1")
        .select("digest", "size", F.col("best.id").alias("best_id"), F.col("best.i").alias("i"), F.col("best.f").alias("f"))
    )
    known = staged(groups, "equal-payloads").withColumnRenamed("digest", "d")
    same = (F.col("digest") == F.col("d")) & (F.octet_length("payload") == F.col("size"))
    marked = slim.join(known, same, "left").select(
        "id", "url", "payload", "digest", "best_id",
        (F.col("d").isNotNull() & ~((F.col("i") == -F.col("_ri")) & (F.col("f") == -F.col("_rf")))).alias("revisit"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                rows = zip(*(part.column(c).to_pylist() for c in ("id", "url", "payload", "digest", "best_id", "revisit")))
                yield pa.RecordBatch.from_pydict({"value": pa.array([member(record_bytes(*r)) for r in rows], pa.binary())})

    (
        arrow_stage(marked, pack, "value binary").select(F.col("value").cast("string"))
        .write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    )


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Columns of RECORD and FRAGMENT: a row is one or the other."""
    pieces = (
        spark.read.option("lineSep", MAGIC.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
        .select(
            F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )
    names = [c.split()[0] for c in f"{RECORD}, {FRAGMENT}".split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        none = (None,) * 7
        where, members, seq = None, Members(), 0
        rows: list[tuple] = []

        def fragment(piece):
            nonlocal seq
            seq += 1
            return (*none, *where, seq, piece)

        def unfinished():
            return [fragment(x) for x in members.raw] if members.unpacker is not None else []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            size = 0
            for value, file, block in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != where:
                    rows += unfinished()
                    where, members, seq = (file, block), Members(), 0
                    if block == 0 and not value:
                        continue  # nothing stands before a file's first magic
                piece = MAGIC + value
                kind, data = members.add(piece)
                if kind == "loose":
                    rows.append(fragment(piece))
                elif kind == "record" and data:
                    rows.append((*parse_record(data), None, None, None, None))
                size += len(piece)
                if size > 1 << 20 and rows:
                    yield batch_of(rows)
                    rows, size = [], 0
        rows += unfinished()
        if rows:
            yield batch_of(rows)

    return arrow_stage(pieces, run, f"{RECORD}, {FRAGMENT}")


def _join_fragments(rows: pd.DataFrame) -> pd.DataFrame:
    """Records whose pieces lie in several byte ranges of one file, or that the magic cuts before their first bytes show.

    In order, the fragments are whole members one after another: where one ends the next begins, so
    none has to be recognised by its first piece, and what is no member is an error.
    """
    out, unpacker, data = [], None, []

    def wrong(what: str) -> ValueError:
        return ValueError(f"{what} in {rows['file'].iloc[0]}")

    for piece in rows.sort_values(["block", "seq"])["piece"]:
        if unpacker is None:
            unpacker, data = zlib.decompressobj(31), []
        try:
            data.append(unpacker.decompress(piece))
        except zlib.error as e:
            raise wrong("bytes that belong to no gzip member") from e
        if not unpacker.eof:
            continue
        unpacker, record = None, b"".join(data)
        if record and not record.startswith(b"WARC/"):
            raise wrong("a gzip member that is no WARC record")
        if record:
            out.append(parse_record(record))
    if unpacker is not None:
        raise wrong("a gzip member without an end")
    return pd.DataFrame(out, columns=[c.split()[0] for c in RECORD.split(", ")])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the files under ``path``; columns of RECORD."""
    scanned = _scan(spark, path)
    whole = scanned.where("file IS NULL").select(*[c.split()[0] for c in RECORD.split(", ")])
    parts = scanned.where("file IS NOT NULL").select("file", "block", "seq", "piece")
    return whole.unionByName(parts.groupBy("file").applyInPandas(_join_fragments, RECORD))


@query(
    "op8_warc",
    """
    with p as (
        select page_id, coalesce(html, '') as html, octet_length(encode(coalesce(html, ''))) as payload_bytes
        from pages
    ),
    g as (
        select *, sha1(html) as payload_digest, max(page_id) over (partition by html) as best from p
    )
    select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
           case when payload_bytes >= 1000 and page_id <> best then 'revisit' else 'response' end as record_type,
           case when payload_bytes >= 1000 and page_id <> best then best end as refers_to
    from g
    """,
)
def op8_warc(spark, sf_dir):
    path = staging_path(spark, "archive")
    write_archive(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1), F.lit("")).cast("long")
    return read_archive(spark, path).select(
        page("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        "record_type", page("refers_to_id").alias("refers_to"),
    )
