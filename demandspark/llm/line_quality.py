r"""Operator 6: quality rules, line first.

Every line is judged on its own: does it look like prose by its punctuation, like a
navigation bar, like boilerplate? Failing lines are removed; a document that loses too
large a share of its characters is rejected, as is one that fails the base rules (too few
words, too many repeated) on its whole text. The words that are left are not counted
again. The base counts are taken in the same pass. One narrow stage without a shuffle.

Base: words are ``[^\x20\x09-\x0D]+``; ``n_repeat_words`` are the words in windows of three
words that occur twice or more in the text.

Defined cases: null text has no words and fails the base rules; an empty text as well; ids
and other columns pass as they are, null or repeated; a column of a new column's name is
replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from demandspark.llm.common import table, text_stage
from demandspark.llm.registry import query

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
# Characters that prose has few of, and the largest share of a prose line that they take.
MARKS = "#*$%&|<>!=+~^@_{}[]\\/"
MARK_SHARE = 0.12
# A line of a few words without an end mark is a heading, a button or a menu entry.
END_MARKS = tuple(".!?:;,)\"'…»”’。！？")
FRAGMENT_WORDS = 3
SEPARATORS = re.compile(r"\s[|›»•·>]\s|\s/\s")
MENU_SEPARATORS = 3
BOILERPLATE = re.compile(
    r"all rights reserved|terms (?:of|and) (?:use|service|conditions)|privacy policy|cookie policy|"
    r"uses? cookies|enable javascript|lorem ipsum|sign up for our|subscribe to our|share on (?:facebook|twitter)|"
    r"skip to (?:main )?content|tous droits réservés|alle rechte vorbehalten|todos los derechos reservados",
    re.IGNORECASE,
)
# Largest share of the characters in words that a kept document may lose.
LOST_SHARE = 0.4

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, lost_chars long, kept boolean, cleaned string"
)


def line_fails(line: str) -> bool:
    """Whether a line with a word is removed."""
    if sum(map(line.count, MARKS)) > MARK_SHARE * len(line):
        return True
    if len(SEPARATORS.findall(line)) >= MENU_SEPARATORS or BOILERPLATE.search(line):
        return True
    return len(line.split()) <= FRAGMENT_WORDS and not line.rstrip().endswith(END_MARKS)


def repeated_words(words: list) -> int:
    """Words covered by three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    first: dict = {}
    ids = np.fromiter(map(first.setdefault, words, range(n)), np.int64, n)
    pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)[1]
    _, back, counts = np.unique(pairs * n + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[back] > 1
    covered = np.zeros(n, bool)
    for i in range(3):
        covered[i : i + n - 2] |= twice
    return int(covered.sum())


def judge(text: str | None) -> dict:
    """Counts, verdict and cleaned text of one document."""
    text = text or ""
    words = text.encode().split()
    lines = text.split("\n")
    seen: set[str] = set()
    n_dup, lost, good = 0, 0, []
    for line in lines:
        chars = len(line) - sum(map(line.count, BLANKS))
        if not chars:
            good.append(line)
            continue
        again = line in seen
        n_dup += again
        seen.add(line)
        if again or line_fails(line):
            lost += chars
        else:
            good.append(line)
    n_words, repeated = len(words), repeated_words(words)
    word_chars = len(text) - sum(map(text.count, BLANKS))
    base_failed = n_words < 50 or 100 * repeated > 50 * n_words
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": n_dup, "n_repeat_words": repeated, "base_failed": base_failed, "lost_chars": lost,
        "kept": not base_failed and lost <= LOST_SHARE * word_chars, "cleaned": "\n".join(good),
    }


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with the counts, the verdict and the cleaned text."""

    def work(texts):
        rows = [judge(t) for t in texts]
        return {c: [r[c] for r in rows] for c in (rows[0] if rows else judge(""))}

    return text_stage(docs, text, COLUMNS, lambda: work)


@query("op6_line_quality")
def op6_line_quality(spark, sf_dir):
    return clean(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("cleaned")
