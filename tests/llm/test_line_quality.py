import re
from collections import Counter

from demandspark.llm import line_quality

from tests.llm.conftest import prose


def base(text):
    """The base counts by regular expressions and dictionaries."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def test_base_counts(spark, odd, odd_documents):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = line_quality.op6_line_quality(spark, odd).select(*names).collect()
    assert Counter(tuple(r) for r in rows) == Counter((d[0], *base(d[1])) for d in odd_documents)


def test_base_counts_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in line_quality.clean(docs.withColumn("t", docs["text"])).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(r["t"])


def test_lines_are_removed_by_their_own_rules():
    assert line_quality.line_fails("Home | About | Contact | Login")
    assert line_quality.line_fails("Read more")
    assert line_quality.line_fails("Copyright 2020 Example. All rights reserved.")
    assert line_quality.line_fails("AND!! THE!! RIVER!! IS!! HERE!!")
    assert not line_quality.line_fails("The river was quiet that morning, and nobody spoke.")
    assert not line_quality.line_fails("Es war ein stiller Morgen am Fluss")
    assert not line_quality.line_fails("Yes.")


def test_verdicts():
    good = prose(1, 200)
    assert line_quality.judge(good)["kept"]
    assert line_quality.judge(good + "\nHome | About | Contact | Login")["cleaned"] == good
    assert not line_quality.judge(good + "\n" + "\n".join(["a | b | c | d | e | f | g"] * 100))["kept"]
    assert not line_quality.judge("too short.")["kept"]
    assert not line_quality.judge(None)["kept"] and line_quality.judge(None)["base_failed"]


def test_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = line_quality.op6_line_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert not any(r["kept"] for r in rows if r["quality"] == 0)
    assert all(r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"])


def test_empty_table_and_clashing_names(spark, empty, clashing):
    assert line_quality.op6_line_quality(spark, empty).count() == 0
    assert line_quality.clean(clashing).where("typeof(kept) = 'boolean'").count() == clashing.count()
