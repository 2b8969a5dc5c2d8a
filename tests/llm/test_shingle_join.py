import random
import re
from collections import Counter

import numpy as np
import pytest

from demandspark.llm import shingle_join
from demandspark.llm.signature_trees import Join
from tests.llm.conftest import prose


def slow_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def labels(sets, percent=80):
    """Smallest index reachable over links."""
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * (o := len(a & b)) >= percent * (len(a) + len(b) - o):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(sets))]


def expected(rows):
    sets = [slow_set(r[1]) for r in rows]
    label = labels(sets)
    smallest = {}
    for r, c in zip(rows, label):
        if r[0] is not None:
            smallest[c] = min(smallest.get(c, r[0]), r[0])
    return Counter((r[0], len(s), smallest.get(c)) for r, s, c in zip(rows, sets, label))


def changed(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, families=25, members=6, words=120):
    """Families of near copies at the edge of the threshold, chains, shared passages, short texts."""
    rng = random.Random(seed)
    passage = prose(seed, 60)
    texts = []
    for f in range(families):
        base = prose(1000 * seed + f, rng.randint(5, words))
        texts.append(base)
        for _ in range(members):
            texts.append(changed(rng, rng.choice([base, texts[-1]]), rng.choice([0, 1, 2, 3, len(base.split()) // 45])))
        texts.append(base + " " + passage)
        texts.append(passage + " " + prose(f, rng.randint(1, 20)))
    texts += ["a b", "A  b", "a b c", None, "", " \n", "x", "x", prose(3, 9000), prose(3, 9000) + " end"]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("shard", [1 << 10, 7])
def test_matches_brute_force(spark, tmp_path, shard):
    rows = corpus(1)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = shingle_join.similar(docs, shard=shard).select("id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == expected(rows)


def test_odd_and_empty_tables(spark, odd, odd_documents, empty):
    assert Counter(map(tuple, shingle_join.op12_jaccard_join(spark, odd).collect())) == expected(odd_documents)
    assert shingle_join.op12_jaccard_join(spark, empty).count() == 0


def test_frames_that_are_no_scan_and_clashing_names(spark, odd_documents, clashing):
    wide = clashing.withColumns({n: clashing["p"] for n in ("n", "digest", "sender", "owner", "set", "node", "n_shingles")})
    other = wide.unionByName(spark.createDataFrame([(99, prose(1, 120))], "doc_id long, text string"), allowMissingColumns=True)
    found = shingle_join.similar(other).select("id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, found)) == expected([r[:2] for r in odd_documents] + [(99, prose(1, 120))])


def components_of(sets, links):
    label = np.arange(len(sets))
    for a, b in links:
        label[label == label[a]] = label[b]
    return {frozenset(np.flatnonzero(label == x)) for x in label}


@pytest.mark.parametrize("seed", range(4))
def test_dual_traversal_connects_what_is_linked(seed):
    rng = np.random.default_rng(seed)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 1 << 63, int(rng.integers(1, 300)), dtype=np.uint64) * np.uint64(2)
        sets.append(np.unique(base))
        for _ in range(5):
            kept = base[rng.random(len(base)) > rng.choice([0.0, 0.02, 0.1, 0.2])]
            sets.append(np.unique(np.append(kept, rng.integers(0, 1 << 63, int(rng.integers(1, 9)), dtype=np.uint64))))
    plain = [set(s.tolist()) for s in sets]
    wanted = labels(plain)
    wanted = {frozenset(i for i, x in enumerate(wanted) if x == y) for y in wanted}
    whole = Join(sets, np.arange(len(sets)), 80)
    whole.run(np.arange(len(sets)))
    assert components_of(sets, whole.links) == wanted and len(whole.links) == len(sets) - len(wanted)
    cells = np.arange(len(sets)) % 3
    links = []
    for i in range(3):
        for j in range(i, 3):
            part = Join(sets, np.arange(len(sets)), 80)
            part.run(np.flatnonzero(cells == i), np.flatnonzero(cells == j) if i != j else None)
            links += part.links
    assert components_of(sets, links) == wanted
    for a, b in links:
        o = len(plain[a] & plain[b])
        assert 180 * o >= 80 * (len(plain[a]) + len(plain[b]))


def test_shingles_are_distinct_and_cover_the_text():
    shingles = shingle_join.Shingles()
    for text in ["A b c d E f", "a b c d e f a b c d e f", "x", "x y z", prose(9, 500), "", None, "É é ÉÉ b c"]:
        tokens = shingles(text)
        assert len(tokens) == len(slow_set(text)) and (np.diff(tokens.view(np.uint64)) > 0).all()
    assert (shingles("A B c D e") == shingles(" a\tb c d\n e")).all()
    assert shingles("É b c d e") != shingles("é b c d e")
