import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from demandspark.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = n_chars if n_chars is None else n_chars + more
    return H(*[field(x) for x in (doc_id, source, lang, n_chars, text)])


def climb(nodes):
    """Levels of one tree, from its leaves to its top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def path(levels, i):
    """(sibling on the left, sibling on the right) of each level."""
    for nodes in levels[:-1]:
        yield ("".join(nodes[i - 1 : i]) if i & 1 else "", "" if i & 1 else "".join(nodes[i + 1 : i + 2]))
        i >>= 1


def brute_force(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    made = {}
    for lang in langs:
        ordered = sorted(trees[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        made[lang] = ordered, climb([leaf(r) for r in ordered])
    top = climb([made[lang][1][-1][0] for lang in langs])
    for k, lang in enumerate(langs):
        ordered, levels = made[lang]
        for i, row in enumerate(ordered):
            steps = [*path(levels, i), *path(top, k)]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            now = leaf(row, 1 if hit else 0)
            for left, right in steps:
                now = H(left, now, right)
            yield row[0], leaf(row), levels[-1][0], top[-1][0], H(*[a + b for a, b in steps]), now, now == top[-1][0]


def rows_of(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(["en"] * 6 + ["de", None, "é", f"only{i}" if i % 40 == 0 else "z"])
        out.append((rng.choice([i, i // 3, None]), rng.choice([None, "", "té x"]), lang, "s", rng.choice([None, i, 2**63 - 1])))
    return out + out[: n // 10]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("n", [1, 2, 37, 700])
def test_query_matches_brute_force(spark, tmp_path, monkeypatch, n):
    rows = rows_of(n, n)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = Counter(tuple(r) for r in merkle.op11_merkle_manifest(spark, str(tmp_path)).collect())
    assert found == Counter(brute_force(rows))


@pytest.mark.parametrize("height", [1, 3])
def test_blocks_of_any_height_give_the_same_proofs(spark, height):
    rows = rows_of(150, 5)
    docs = spark.createDataFrame(rows, SCHEMA)
    small, large = merkle.manifest(docs, height=height).drop("keep"), merkle.manifest(docs).drop("keep")
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))
    assert small.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


def test_odd_and_empty_tables(spark, odd, odd_documents, empty, clashing):
    expected = Counter(brute_force(odd_documents))
    assert Counter(tuple(r) for r in merkle.op11_merkle_manifest(spark, odd).collect()) == expected
    assert merkle.op11_merkle_manifest(spark, empty).count() == 0
    names = ["tree", "digest", "load", "place", "leaf", "at", "block"]
    wide = clashing.withColumns({n: F.lit(1) for n in names})
    assert Counter(r["leaf"] for r in merkle.manifest(wide).collect()) == Counter(e[1] for e in expected.elements())


def test_a_changed_leaf_gives_another_root():
    digests = [bytes([i]) * 32 for i in range(11)]
    made = merkle.sweep(digests, 4)
    assert made[-1] == [bytes.fromhex(climb([d.hex() for d in digests])[-1][0])]
    other = merkle.sweep([b"\0" * 32 if i == 6 else d for i, d in enumerate(digests)], 4)
    assert other[-1] != made[-1] and [len(x) for x in made] == [11, 6, 3, 2, 1]
