import gzip
import hashlib
import os
import zlib
from collections import Counter, defaultdict

import pandas as pd
import pytest

from demandspark.llm import warc
from demandspark.staging import staging_path

BIG = "<p>" + "payload é " * 150


def page_rows():
    rows = [(i, f"http://h/{i}?q=é x\r\n", f"<html>{i}" + "x" * (i * 7 % 3000)) for i in range(300)]
    rows += [(1000 + i, "http://same", BIG) for i in range(200)]
    rows += [(2000, None, None), (2001, "u", ""), (None, "u", "no id"), (None, "u", BIG), (7000, "u", "short"), (7001, "u", "short")]
    return rows + [(8000, "u", BIG + "!"), (8000, "u", BIG + "!"), (-5, "u", "negative")]


def expected(rows):
    groups = defaultdict(list)
    for i, (page, _, html) in enumerate(rows):
        groups[html or ""].append((page is not None, page or 0, -i, page))
    out = Counter()
    for html, members in groups.items():
        raw = html.encode()
        best = max(members)
        for m in members:
            revisit = len(raw) >= 1000 and m is not best
            out[m[3], len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", best[3] if revisit else None] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("pages"))
    spark.createDataFrame(page_rows(), "page_id long, url string, html string").coalesce(1).write.parquet(f"{root}/pages.parquet")
    return root


def test_query_matches_brute_force(spark, pages):
    assert Counter(tuple(r) for r in warc.op8_warc(spark, pages).collect()) == expected(page_rows())


@pytest.mark.parametrize("size", ["5k", "1500b"])
def test_byte_ranges_of_any_size_give_the_same_records(spark, pages, size):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    path = staging_path(spark, "archive")
    docs = spark.read.parquet(f"{pages}/pages.parquet").where("page_id < 20 or page_id is null")
    warc.write_archive(docs.repartition(2), path)
    whole = {bytes(r["payload"] or b"") for r in warc.read_archive(spark, path).collect()}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        rows = warc.read_archive(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == docs.count() and {bytes(r["payload"] or b"") for r in rows} == whole


def test_chance_magic_inside_a_member_does_not_cut_it():
    record = warc.record_bytes(1, "u", os.urandom(50_000), "d", None, False)
    raw = warc.member(record)
    at = [10_000, 20_000, len(raw) - 3]  # pieces as if the magic stood there
    members = warc.Members()
    states = [members.add(raw[a:b]) for a, b in zip([0, *at], [*at, len(raw)])]
    assert [s for s, _ in states] == ["open", "open", "open", "record"] and states[-1][1] == record
    assert warc.Members().add(warc.MAGIC + os.urandom(30)) == ("loose", None)


def named(data, name):
    """A gzip member with a file name in its header."""
    packer = zlib.compressobj(3, wbits=-15)
    body = packer.compress(data) + packer.flush()
    sizes = zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")
    return warc.MAGIC + b"\x08" + bytes(5) + b"\x03" + name + b"\0" + body + sizes


def test_magic_before_the_first_bytes_show_loses_no_record(spark, tmp_path):
    odd = [b"", b"a", b"ab" * 40]  # the magic in the header, where nothing is unpacked yet
    records = [warc.record_bytes(i, "u", b"payload %d " % i * 50, "d", None, False) for i in range(40)]
    for f in range(2):
        members = [
            named(r, odd[i // 4 % 3] + warc.MAGIC + b"name" + warc.MAGIC) if i % 4 == 1 else warc.member(r)
            for i, r in enumerate(records) if i % 2 == f or i % 4 == 1
        ]
        (tmp_path / f"part-{f}").write_bytes(b"".join(members))
    expected = Counter(f"<urn:page:{i}>" for f in range(2) for i in range(40) if i % 2 == f or i % 4 == 1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        for size in (before, "300b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert Counter(r["record_id"] for r in warc.read_archive(spark, str(tmp_path)).collect()) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def fragments(*pieces):
    return pd.DataFrame([("f", 0, i, p) for i, p in enumerate(pieces)], columns=["file", "block", "seq", "piece"])


def test_fragments_are_joined_or_refused():
    raw = warc.member(warc.record_bytes(1, "u", b"payload", "d", None, False))
    for at in (12, 30, len(raw) - 4):
        assert list(warc._join_fragments(fragments(raw[:at], raw[at:], warc.EMPTY_MEMBER, raw))["record_id"]) == ["<urn:page:1>"] * 2
    for pieces in ([raw[30:]], [raw[:30]], [raw, raw[:30]], [warc.member(b"no record")]):
        with pytest.raises(ValueError):
            warc._join_fragments(fragments(*pieces))


def test_archives_are_plain_gzip(spark, pages):
    path = staging_path(spark, "archive")
    warc.write_archive(spark.read.parquet(f"{pages}/pages.parquet"), path)
    files = [f"{path}/{f}" for f in os.listdir(path) if f.startswith("part-")]
    text = b"".join(gzip.decompress(open(f, "rb").read()) for f in files)
    assert text.count(b"WARC/1.1\r\n") == len(page_rows())


def test_empty_table(spark, empty):
    assert warc.op8_warc(spark, empty).count() == 0
