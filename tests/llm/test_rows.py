"""Row identity: functions that drop or change rows, on frames that are no plain scan."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from demandspark.llm import exact_dedup, language_id, packing, secrets, shingle_join, simhash
from demandspark.llm.common import keyed, stored
from tests.llm.conftest import SCHEMA, prose
from tests.llm.test_simhash import labels, slow_fingerprint

SECRET = 'password = "hunter2hunter2"'


def rows():
    texts = [prose(1, 60), prose(1, 60) + " ", prose(2, 60), prose(2, 60), prose(3, 70), SECRET + " " + prose(4, 30), "12 34", None]
    return [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def frames(spark, path):
    plain = spark.createDataFrame(rows(), SCHEMA)
    plain.write.parquet(f"{path}/p")
    plain.write.json(f"{path}/j")
    scan = spark.read.parquet(f"{path}/p")
    paragraphs = spark.createDataFrame([(0, [r[1] for r in rows()])], "doc_id long, parts array<string>")
    paragraphs.write.parquet(f"{path}/e")
    apart = spark.read.parquet(f"{path}/e").select(F.posexplode("parts").alias("doc_id", "text"))
    return {
        "memory": plain, "json": spark.read.schema(SCHEMA).json(f"{path}/j"), "scan": scan.where("doc_id >= 0").select("*"),
        "union": scan.where("doc_id < 4").unionByName(scan.where("doc_id >= 4")),
        "join": scan.join(spark.range(8).withColumnRenamed("id", "doc_id"), "doc_id").select(*scan.columns),
        "explode": apart.select(F.col("doc_id").cast("long"), "text", F.lit("en").alias("lang"), F.lit("s").alias("source"),
                                F.length("text").cast("long").alias("n_chars")),
    }


@pytest.fixture(scope="module", params=["memory", "json", "scan", "union", "join", "explode"])
def frame(request, spark, tmp_path_factory):
    return frames(spark, str(tmp_path_factory.mktemp(request.param)))[request.param]


def test_each_row_has_one_name(frame):
    docs = stored(frame)
    first, again = (sorted(map(tuple, keyed(docs).select("rec.doc_id", "_rf", "_ri").collect())) for _ in range(2))
    assert first == again and len({r[1:] for r in first}) == len(rows())


def test_exact_copies(frame):
    kept = {}
    for doc_id, text, *_ in rows():
        kept.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id))
    left = exact_dedup.drop_duplicates(frame)
    assert left.columns == frame.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(min(g)[1] for g in kept.values())
    assert Counter(r["group_size"] for r in exact_dedup.duplicates(frame).collect()) == Counter(len(g) for g in kept.values() for _ in g)


def test_near_copies(frame):
    label = labels([slow_fingerprint(r[1]) for r in rows()])
    assert sorted(r["doc_id"] for r in simhash.keep_one(frame).collect()) == sorted(set(label.tolist()))
    same = {r["id"]: r["component_id"] for r in shingle_join.similar(frame).collect()}
    assert same == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 5, 6: 6, 7: 7}


def test_languages_and_secrets(frame):
    assert sorted(r["doc_id"] for r in language_id.keep_known(frame, 0.0).collect()) == [0, 1, 2, 3, 4, 5]
    found = {r["doc_id"]: r["text"] for r in secrets.mask(frame).collect()}
    wanted = {r[0]: r[1] for r in rows()}
    assert "hunter2" not in found.pop(5) and wanted.pop(5)
    assert found == wanted


def test_token_ids_replace_a_column_of_that_name(clashing):
    import public_tokenizers

    found = packing.token_ids(clashing, public_tokenizers.path("word_bpe_49k.json"))
    assert dict(found.dtypes)["ids"] == "binary" and found.count() == clashing.count()
