import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from demandspark.llm import simhash
from demandspark.llm.bk_trees import Forest
from demandspark.llm.components import components
from demandspark.staging import staged


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def labels(values, radius=3):
    """Smallest index reachable over links of at most ``radius`` bits."""
    values = np.array(values, np.uint64)
    label, before = np.arange(len(values)), None
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= radius) for v in values]
    while before is None or (label != before).any():
        before, label = label, np.array([label[n].min() for n in near])
    return label


def clustered(n, seed):
    """Fingerprints with chains and dense balls among random ones."""
    rng = np.random.default_rng(seed)
    values = [int(v) for v in rng.integers(0, 1 << 63, n)]
    for _ in range(n):
        v = values[int(rng.integers(0, len(values)))]
        for bit in rng.integers(0, 64, int(rng.integers(1, 6))):
            v ^= 1 << int(bit)
        values.append(v)
    ball = values[0]
    values += [ball ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)]
    return sorted(set(values))


def test_fingerprints(odd_documents):
    for _, text, *_ in odd_documents:
        assert simhash.fingerprint(text) & (2**64 - 1) == slow_fingerprint(text)


def test_tree_searches_find_all_within_the_radius():
    values = np.array(clustered(300, 1), np.uint64)
    group = np.sort(np.random.default_rng(2).integers(0, 5, len(values)))
    forest = Forest(values, group)
    roots = np.array([forest.root[int(g)] for g in group])
    found = {(int(q), int(n)) for a, b in forest.search(values, roots, 3) for q, n in zip(a, b)}
    wanted = {
        (i, j) for i in range(len(values)) for j in np.flatnonzero((np.bitwise_count(values ^ values[i]) <= 3) & (group == group[i]))
    }
    assert found == wanted


@pytest.mark.parametrize("shard_nodes", [simhash.SHARD_NODES, 50])
def test_links_connect_what_is_linked(spark, shard_nodes):
    values = clustered(400, 3)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    nodes = staged(spark.createDataFrame([(v,) for v in signed], "fp long"), "nodes")
    links = simhash.links(nodes, shard_nodes=shard_nodes)
    assert links.where("bit_count(a ^ b) > 64").count() == 0
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    mine = [roots.get(v, v) for v in signed]
    label = labels(values)
    assert Counter(Counter(mine).values()) == Counter(Counter(label.tolist()).values())
    assert len({(a, b) for a, b in zip(mine, label)}) == len(set(mine))


def test_long_chains_are_one_component(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000 + i, 999 + i) for i in range(1, 50)] + [(5000, i) for i in range(2000, 2400)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(roots[i] == 0 for i in range(61)) and all(roots[i] == 1000 for i in range(1000, 1049))
    assert roots[5000] == 2000 and roots[1049] == 1000 and len(roots) == 61 + 50 + 401


def test_query_matches_brute_force(spark, odd, odd_documents):
    rows = simhash.op4_simhash(spark, odd).collect()
    prints = [slow_fingerprint(t) for _, t, *_ in odd_documents]
    label = labels(prints)
    smallest = {}
    for (doc_id, *_), c in zip(odd_documents, label):
        if doc_id is not None:
            smallest[c] = min(smallest.get(c, doc_id), doc_id)
    expected = Counter((d[0], f"{p:016x}", smallest.get(c)) for d, p, c in zip(odd_documents, prints, label))
    assert Counter(tuple(r) for r in rows) == expected


def test_one_row_of_each_component_stays(odd_documents, clashing):
    left = simhash.keep_one(clashing)
    assert left.columns == clashing.columns
    assert left.count() == len(set(labels([slow_fingerprint(t) for _, t, *_ in odd_documents])))


def test_empty_table(spark, empty):
    assert simhash.op4_simhash(spark, empty).count() == 0
