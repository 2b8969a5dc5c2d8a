"""The corpus pipeline, stage by stage against brute force."""

import re
from collections import Counter, defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from demandspark.llm import secrets
from demandspark.staging import staged
from tests.llm.test_simhash import labels, slow_fingerprint


def test_stages_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "sequences":
            assert out.columns == columns
            docs = staged(out, name)
            seen[name] = {r["doc_id"]: r for r in docs.collect()}
            assert len(seen[name]) == docs.count()

    lettered = {d for d, r in before.items() if r["text"] and any(map(str.isalpha, r["text"]))}
    assert set(seen["language"]) <= lettered and len(lettered - set(seen["language"])) <= 2

    groups = defaultdict(list)
    for d, r in seen["language"].items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"])].append((-len(r["text"]), d))
    assert set(seen["exact_copies"]) == {min(g)[1] for g in groups.values()}

    ids = sorted(seen["exact_copies"])
    label = labels([slow_fingerprint(seen["exact_copies"][d]["text"]) for d in ids])
    assert set(seen["near_copies"]) == {ids[i] for i in set(label)}

    assert set(seen["secret_spans"]) == set(seen["near_copies"])
    for d, r in seen["secret_spans"].items():
        old = seen["near_copies"][d]
        spans = secrets.rule_spans(old["text"])
        if spans:
            assert all(old["text"][a:b] not in r["text"] for a, _, b in spans)
        elif secrets.MASK not in r["text"]:
            assert r == old

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter()
    for p in out.collect():
        lengths[p["doc_id"]] += p["length"]
    assert lengths == {d: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for d, r in seen["secret_spans"].items()}


def test_odd_and_empty_tables_pass(spark, odd, empty):
    assert corpus_pipeline.run(spark, odd).count() > 0
    assert corpus_pipeline.run(spark, empty).count() == 0
