import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandspark.llm import byte_bpe, prefix_counts
from demandspark.llm.pretokens import split

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [*"aab'strevlmd  \n\n\t　\xa0\x0b19²½é漢!?.,-\x1c\x85😀'''", "'s", "'re", "'ll", " '"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    return ["", " ", "'", "  a", *("".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(n))]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )


def test_pre_tokens_are_those_of_the_pattern():
    import regex

    pattern = regex.compile(public_tokenizers.PATTERN)
    texts = random_texts(3000)
    assert [p for p, _ in split(texts)] == [pattern.findall(t) for t in texts]


def test_ids_match_the_library_and_decode_to_the_text(spark, odd, odd_documents, library):
    rows = byte_bpe.op5_byte_bpe(spark, odd).collect()
    expected = Counter()
    for doc_id, text, *_ in odd_documents:
        ids = library.encode_ordinary(text or "")
        packed = np.array(ids, "<u4").tobytes()
        expected[doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in rows) == expected


def test_offsets_are_token_ends(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").where("doc_id = 13").select("doc_id", "text")
    (row,) = byte_bpe.encode(docs, RANKS).collect()
    tokens = {i: t for t, i in byte_bpe.read_ranks(RANKS).items()}
    ends = np.cumsum([len(tokens[i]) for i in np.frombuffer(row["ids"], "<u4")])
    assert ends.tolist() == np.frombuffer(row["offsets"], "<u4").tolist()


def test_a_full_cache_changes_nothing(library):
    cache = byte_bpe.merger(byte_bpe.read_ranks(RANKS), entries=3)
    for text in random_texts(200):
        (pieces, _), = split([text])
        ids = np.frombuffer(b"".join(cache[p] for p in pieces), "<u4").tolist()
        assert ids == library.encode_ordinary(text)


def test_counts_match_the_library(spark, odd, odd_documents):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    expected = Counter()
    for doc_id, text, *_ in odd_documents:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected[doc_id, len((text or "").encode()), n, n > 512] += 1
    assert Counter(tuple(r) for r in prefix_counts.op7_token_counts(spark, odd).collect()) == expected


def test_every_prefix_is_exact():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    counter = prefix_counts.PrefixCounter(VOCABULARY)
    for i, text in enumerate(random_texts(250, seed=2)):
        text = text + "<|endoftext|>" * (i % 3 == 0) + text[:5]
        expected = [len(tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert counter.every(text).tolist() == expected


def test_truncation_keeps_the_longest_prefix_within_the_limit(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet").where("doc_id in (1, 5, 6, 13)").select("doc_id", "text")
    tokenizer = Tokenizer.from_file(VOCABULARY)
    texts = dict(docs.collect())
    for row in prefix_counts.truncate(docs, VOCABULARY, 20).collect():
        text = texts[row["doc_id"]] or ""
        counts = [len(tokenizer.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        assert row["kept_chars"] == max(k for k, c in enumerate(counts) if c <= 20)


def test_blocks_give_every_count_back():
    rng = random.Random(7)
    for n in (1, 2, prefix_counts.BLOCK, prefix_counts.BLOCK + 1, 3 * prefix_counts.BLOCK):
        for reach in (1, 300):  # steps of one byte, and of four
            counts = np.cumsum([0, *(rng.randrange(-reach, reach + 1) for _ in range(n - 1))])
            blocks = prefix_counts.pack_counts(counts)
            assert np.concatenate([prefix_counts.unpack_counts(b["counts"]) for b in blocks]).tolist() == counts.tolist()


def test_budgets_are_answered_from_the_stored_table(spark, tmp_path):
    rng = random.Random(3)
    long = "".join(rng.choice(ALPHABET) for _ in range(2 * prefix_counts.BLOCK))
    texts = [long, None, "", "x", " " * 5000 + "word", "<|endoftext|>" * 700, *random_texts(40, seed=9)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    prefix_counts.prefix_store(docs, VOCABULARY).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))  # no text and no vocabulary from here on
    assert stored.columns == ["doc_id", "blocks"]
    counter = prefix_counts.PrefixCounter(VOCABULARY)
    every = {i: counter.every(t or "") for i, t in enumerate(texts)}
    for limit in (0, 1, 20, 5000, 10**6):
        for r in prefix_counts.truncate_stored(stored, limit).collect():
            k = int(np.flatnonzero(every[r["doc_id"]] <= limit)[-1])
            assert (r["kept_chars"], r["kept_tokens"]) == (k, every[r["doc_id"]][k])
    for position in (-3, 0, 1, prefix_counts.BLOCK - 1, prefix_counts.BLOCK, prefix_counts.BLOCK + 1, 10**12):
        for r in prefix_counts.count_at(stored, F.lit(position)).collect():
            counts = every[r["doc_id"]]
            assert r["tokens_at"] == counts[min(max(position, 0), len(counts) - 1)]
    asked = F.when(F.col("doc_id") > 1, F.col("doc_id"))
    assert prefix_counts.count_at(stored, asked, "n").where("n is null").count() == 2
    with pytest.raises(ValueError):
        prefix_counts.truncate_stored(stored, -1)


def test_empty_table(spark, empty):
    assert byte_bpe.op5_byte_bpe(spark, empty).count() == 0
    assert prefix_counts.op7_token_counts(spark, empty).count() == 0


def test_clashing_names_pass(clashing):
    n = clashing.count()
    assert byte_bpe.round_trip(clashing.withColumn("decoded", clashing["p"]), RANKS).columns.count("ids") == 1
    assert byte_bpe.round_trip(clashing.withColumn("offsets", clashing["p"]), RANKS).count() == n
    assert prefix_counts.prefix_table(clashing.withColumn("totals", clashing["p"]), VOCABULARY).count() == n
    wide = clashing.withColumn("kept_chars", clashing["p"])
    assert prefix_counts.truncate(wide, VOCABULARY, 5).where("kept_tokens <= 5").count() == n
