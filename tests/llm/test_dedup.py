import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from demandspark.llm import exact_dedup, golomb

HUGE = 1 << 62


def brute(rows):
    """(id, keep_id, group_size, kept, sha) of each row, by dictionaries."""
    groups = defaultdict(list)
    for i, (doc_id, text, *_) in enumerate(rows):
        bare = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups[bare].append((-len(text or ""), HUGE if doc_id is None else doc_id, i))
    out = Counter()
    for bare, members in groups.items():
        sha = hashlib.sha256(bare.encode()).hexdigest()
        best = min(members)
        for m in members:
            ids = [None if x[1] == HUGE else x[1] for x in (m, best)]
            out[ids[0], ids[1], len(members), sha] += 1
    return out


@pytest.mark.parametrize("bits,n", [(20, 1000), (40, 3), (62, 500), (12, 4096), (30, 1)])
def test_golomb_round_trip(bits, n):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64))
    assert (golomb.decode(len(values), *golomb.encode(values, bits)) == values).all()


def test_codes_are_near_the_optimum():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 10_000, dtype=np.uint64))
    _, unary, remainders = golomb.encode(values, 40)
    assert 8 * (len(unary) + len(remainders)) / len(values) < np.log2((1 << 40) / len(values)) + 2


def test_groups_match_brute_force(spark, odd, odd_documents):
    rows = exact_dedup.op3_exact_dedup(spark, odd).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == brute(odd_documents)
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len({r["text_sha256"] for r in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])


def test_a_third_of_all_rows_is_one_text(spark, tmp_path):
    rows = [(i, "same text" if i % 3 == 0 else f"text number {i % 700}", "en", "s", 0) for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    found = exact_dedup.op3_exact_dedup(spark, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found) == brute(rows)


def test_false_suspects_are_cleared(spark, odd, odd_documents, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_SPARE_BITS", 0)  # nearly every row becomes a suspect
    rows = exact_dedup.op3_exact_dedup(spark, odd).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == brute(odd_documents)


def test_rows_are_dropped_with_their_columns(spark, odd_documents, clashing):
    left = exact_dedup.drop_duplicates(clashing)
    assert left.columns == clashing.columns
    assert left.count() == len({k[3] for k in brute(odd_documents)})


def test_empty_table(spark, empty):
    assert exact_dedup.op3_exact_dedup(spark, empty).count() == 0
