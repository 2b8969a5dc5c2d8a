import random
import re
import zlib
from collections import Counter

import pytest

from demandspark.llm import spelling
from demandspark.staging import staged

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slow_vocabulary(rows, damage=199, least=5):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}


def slow_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def slow_variants(vocabulary):
    out = {}
    for w, n in vocabulary.items():
        around = sorted((-m, v) for v, m in vocabulary.items() if abs(len(v) - len(w)) <= 1 and slow_near(w, v))
        form = around[0][1] if around and -around[0][0] >= 5 * n else None
        out[w] = [w, form, w, n, len(around), vocabulary[form] if form else None]
    for w in out:
        while out[out[w][2]][1]:
            out[w][2] = out[out[w][2]][1]
    return Counter(map(tuple, out.values()))


def dense(n, letters, seed):
    """Words of few letters: many neighbours, frequent grams, repeated grams within a word."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(n)}
    words |= {w[:i] + rng.choice(letters) + w[i + 1 :] for w in list(words) for i in (0, 3, len(w) - 1)}
    words |= {w[:i] + w[i + 1 :] for w in words for i in (0, 2, len(w) - 1) if len(w) > 6} | {"a" * k for k in range(6, 20)}
    return {w: rng.choice([5, 6, 30, 200, 1500]) for w in words}


@pytest.mark.parametrize("limit, entries, least", [(512, 1 << 16, 32), (3, 50, 2), (512, 5000, 1)])
@pytest.mark.parametrize("letters", ["ab", "abcdeé"])
def test_variants_match_brute_force(spark, letters, limit, entries, least):
    vocabulary = dense(150, letters, 7)
    words = staged(spark.createDataFrame(list(vocabulary.items()), "word string, n long"), "words")
    found = spelling.variants(words, limit=limit, entries=entries, least=least)
    rows = found.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert Counter(map(tuple, rows)) == slow_variants(vocabulary)


def test_near_words_share_one_of_their_first_lists():
    rng = random.Random(3)
    words = list(dense(400, "abc", 11))
    counts = Counter(f"^{w}$"[i : i + k] for w in words for k in range(2, 7) for i in range(len(w) + 3 - k))
    for least in (1, 5, 60):
        frequent = {g: n for g, n in counts.items() if n > least}
        for w in words:
            grams = spelling.decompose(w, frequent)
            assert len(grams) == len(w) + 1 and 1 <= spelling.affected_bound(grams) <= spelling.MAX_GRAM
            i = rng.randrange(len(w) + 1)
            for v in (w[:i] + "c" + w[i:], w[:i] + "c" + w[i + 1 :]):
                if slow_near(w, v):
                    mine, other = set(spelling.first_lists(w, frequent)), set(spelling.first_lists(v, frequent))
                    shifts = {0, 1} if len(v) > len(w) else {0}
                    assert any((g, p + d) in other for g, p in mine for d in shifts)


def test_dictionary_is_bounded(spark):
    vocabulary = dense(300, "abcd", 5)
    words = staged(spark.createDataFrame(list(vocabulary.items()), "word string, n long"), "words")
    assert len(spelling.gram_dictionary(words, entries=40, least=1)) <= 40
    counts = Counter(f"^{w}$"[i : i + k] for w in vocabulary for k in range(2, 7) for i in range(len(w) + 3 - k))
    assert spelling.gram_dictionary(words, entries=1 << 30, least=9) == {g: n for g, n in counts.items() if n > 9}


@pytest.mark.parametrize("a, b, expected", [
    (b"abc", b"abc", False), (b"abc", b"abd", True), (b"abc", b"abcd", True), (b"bc", b"abc", True),
    (b"abc", b"bca", False), (b"abc", b"adc", True), (b"ab", b"abcd", False), (b"", b"x", True), (b"aab", b"ab", True),
])
def test_near(a, b, expected):
    import numpy as np

    assert spelling.near(a, b) is expected
    if abs(len(a) - len(b)) <= 1 and a != b:
        short, long = sorted([a, b], key=len)
        for pad in (b"", b"z" * 80):
            words = [short + pad, long + pad]
            assert spelling.near_pairs(words, np.array([0]), np.array([1])).tolist() == [expected]


def test_query_on_odd_and_empty_tables(spark, odd, odd_documents, empty, tmp_path):
    rows = spelling.op13_spelling_variants(spark, odd).collect()
    assert Counter(map(tuple, rows)) == slow_variants(slow_vocabulary(odd_documents))
    assert spelling.op13_spelling_variants(spark, empty).count() == 0
    long = "x" * 100_000
    texts = [(i, f"{long} {long[1:]} Éternel éternel éternels Naïve naïves") for i in range(7)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = spelling.op13_spelling_variants(spark, str(tmp_path)).collect()
    assert Counter(map(tuple, rows)) == slow_variants(slow_vocabulary(texts))


def test_vocabulary_of_frames_with_other_columns(spark, clashing, odd_documents):
    wide = clashing.withColumns({"word": clashing["p"], "n": clashing["p"], "list": clashing["p"]})
    assert {r["word"]: r["n"] for r in spelling.vocabulary(wide).collect()} == slow_vocabulary(odd_documents, None)
