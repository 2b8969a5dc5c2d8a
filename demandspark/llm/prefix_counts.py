"""Operator 7: token counts by prefix dynamic programming.

For a pre-token, the encoding of its prefix of k bytes ends in exactly one token t for
which (last token of the prefix k - len(t), t) is a pair that merging leaves alone; so the
counts of all prefixes follow from left to right, each from an earlier one. These arrays
are cached by pre-token. A text's counts are running sums over its pre-tokens.

``prefix_store`` writes the count of every prefix, in compressed blocks. ``truncate_stored`` and
``count_at`` answer budget and truncation questions from that table, reading one block a text
and neither the text nor the vocabulary. ``prefix_table`` holds the counts at pre-token ends
only, which is enough for whole texts. All are narrow stages without a shuffle.

Defined cases: null text counts as empty (0 tokens); other columns pass as they are, null
or repeated; a column of a new column's name is replaced; an empty table gives an empty table. The string of an added special token is
that one token, as the library has it by default.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import Cache, table, text_stage
from demandspark.llm.pretokens import is_blank, split
from demandspark.llm.registry import query

# Prefixes in one stored block.
BLOCK = 4096
CACHE_ENTRIES = 300_000
_CACHED_CHARS = 64


def byte_letters() -> dict[str, int]:
    """Letter to byte as byte-level vocabularies write them: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=2)
def read_vocabulary(path: str) -> tuple[dict[bytes, int], tuple[str, ...]]:
    """(token bytes to rank, strings of the special tokens) of a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = tuple(t["content"] for t in spec["added_tokens"] if t["special"])
    byte_of = byte_letters()
    ranks = {
        bytes(byte_of[c] for c in token): i
        for token, i in spec["model"]["vocab"].items() if token not in special
    }
    return ranks, special


class PrefixCounter(Cache):
    """Pre-token to the token counts of its prefixes, by code points; the last is its own."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        import tiktoken

        super().__init__(self._counts, entries, _CACHED_CHARS)
        self.ranks, self.special = read_vocabulary(path)
        merges = tiktoken.Encoding("pieces", pat_str=r"\S+", mergeable_ranks=self.ranks, special_tokens={})
        self._merge = merges._encode_single_piece
        self._longest = max(map(len, self.ranks), default=0)
        self._tokens = {i: t for t, i in self.ranks.items()}
        self._stable: dict[int, bool] = {}
        self._before: tuple = b"", [0], [0]

    def _leaves_alone(self, a: int, b: int) -> bool:
        """Whether merging the bytes of two tokens gives these two tokens again."""
        if len(self._stable) >= 2 * self._entries:
            self._stable.clear()
        alone = self._stable[a << 20 | b] = self._merge(self._tokens[a] + self._tokens[b]) == [a, b]
        return alone

    def _counts(self, piece: str):
        raw = piece.encode()
        n, rank_of, stable = len(raw), self.ranks.get, self._stable
        same, counts, last = 0, *self._before[1:]
        for a, b in zip(raw, self._before[0]):  # what the piece before shares at its start holds here too
            if a != b:
                break
            same += 1
        counts, last = counts[: same + 1], last[: same + 1]
        j = begin if (begin := same - len(self._tokens[last[same]])) > 0 and same else 0
        for k in range(same + 1, n + 1):
            # Most often the last token grows by a byte; any order finds the only fit.
            token = rank_of(raw[j:k])
            if token is None or j and not (
                alone if (alone := stable.get(last[j] << 20 | token)) is not None
                else self._leaves_alone(last[j], token)
            ):
                for j in range(k - 1, max(-1, k - 1 - self._longest), -1):
                    token = rank_of(raw[j:k])
                    if token is None:
                        continue
                    if j == 0:
                        break
                    alone = stable.get(last[j] << 20 | token)
                    if self._leaves_alone(last[j], token) if alone is None else alone:
                        break
            counts.append(counts[j] + 1)
            last.append(token)
        self._before = raw, counts, last
        if n != len(piece):  # keep the counts at code point ends
            counts = [counts[0], *(counts[k] for k in range(1, n + 1) if k == n or raw[k] & 0xC0 != 0x80)]
        return bytes(counts[1:]) if counts[-1] < 256 else counts[1:]

    def learn(self, pieces: list[str]) -> None:
        """Count unseen pre-tokens in order, so that each starts from the prefix it shares."""
        for piece in sorted(set(pieces) - self.keys()):
            self[piece]

    def segments(self, text: str) -> list[tuple[int, str, bool]]:
        """(start, string, is it a special token) of the parts between special tokens."""
        found, start = [], 0
        while True:
            hits = [(text.find(s, start), -len(s), s) for s in self.special]
            hits = [h for h in hits if h[0] >= 0]
            if not hits:
                return [*found, (start, text[start:], False)]
            at, _, s = min(hits)
            found += [(start, text[start:at], False), (at, s, True)]
            start = at + len(s)

    def totals(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ends of the pre-tokens in code points, exact token counts up to there) of each text."""
        parts = [(i, *s) for i, t in enumerate(texts) for s in self.segments(t)]
        cut = split([s for _, _, s, special in parts if not special])
        self.learn([p for pieces, _ in cut for p in pieces])
        plain = iter(cut)
        ends, counts = [[] for _ in texts], [[] for _ in texts]
        for i, start, string, special in parts:
            if special:
                ends[i].append([start + len(string)])
                counts[i].append([1])
            else:
                pieces, starts = next(plain)
                if pieces:
                    ends[i].append(np.append(starts[1:], len(string)) + start)
                    counts[i].append([self[p][-1] for p in pieces])
        none = np.zeros(0, np.int64)
        return [
            (np.concatenate(e).astype(np.int32), np.cumsum(np.concatenate(c)).astype(np.int32)) if e else (none, none)
            for e, c in zip(ends, counts)
        ]

    def every(self, text: str) -> np.ndarray:
        """Exact token count of every prefix of ``text``: n + 1 counts for n code points.

        A prefix may cut a pre-token apart differently from the whole text: a run of white
        space that ends the prefix is one pre-token, a cut contraction is none, and a cut
        special token is plain text. Those few positions are counted on their last part.
        """
        out = np.zeros(len(text) + 1, np.int64)
        base = 0
        tail_start, tail_base = 0, 0  # last cut before a special token that plain text may join
        for start, string, special in self.segments(text):
            if special:
                for k in range(1, len(string)):
                    out[start + k] = tail_base + self._plain(text[tail_start : start + k])
                base += 1
                out[start + len(string)] = base
                tail_start, tail_base = start + len(string), base
                continue
            tail_start, tail_base = start, base
            pieces, starts = split([string])[0]
            blank_start, blank_base = None, 0
            for piece, at in zip(pieces, starts.tolist()):
                counts = self[piece]
                here = start + at
                out[here + 1 : here + len(piece) + 1] = [base + c for c in counts]
                if is_blank(piece[-1]) and blank_start is not None:
                    out[here + 1 : here + len(piece) + 1] = [
                        blank_base + c for c in self[text[blank_start : here + len(piece)]][here - blank_start :]
                    ]
                elif is_blank(piece[0]) and blank_start is not None:  # the space that joins a word
                    out[here + 1] = blank_base + self[text[blank_start : here + 1]][-1]
                if piece in ("'re", "'ve", "'ll"):
                    out[here + 2] = base + self["'"][-1] + self[piece[1]][-1]
                if is_blank(piece[-1]):
                    if blank_start is None:
                        blank_start, blank_base = here, base
                else:
                    blank_start = None
                    tail_start, tail_base = here, base
                base += counts[-1]
        return out

    def _plain(self, string: str) -> int:
        return sum(self[p][-1] for p in split([string])[0][0])


def prefix_table(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``n_bytes``, ``ends`` and ``totals``.

    ``ends`` holds the end of each pre-token in code points, ``totals`` the exact number of
    tokens up to there.
    """

    def make():
        counter = PrefixCounter(path)

        def work(texts):
            texts = [t or "" for t in texts]
            found = counter.totals(texts)
            return {
                "n_bytes": [len(t.encode()) for t in texts],
                "ends": [e for e, _ in found],
                "totals": [c for _, c in found],
            }

        return work

    return text_stage(docs, text, "n_bytes long, ends array<int>, totals array<int>", make)


def tokens(totals: str = "totals"):
    """Column: token count of the whole text."""
    return F.when(F.size(totals) > 0, F.element_at(totals, -1)).otherwise(0).cast("long")


def pack_counts(counts: np.ndarray) -> list[dict]:
    """Blocks of at most BLOCK counts: the least of them, and the first with the compressed steps from it.

    A step is mostly 0 or 1; a block with one beyond a byte has four bytes a step.
    """
    blocks = []
    for at in range(0, len(counts), BLOCK):
        part = counts[at : at + BLOCK]
        steps = np.diff(part)
        small = not len(steps) or -128 <= steps.min() and steps.max() < 128
        raw = np.int32(part[0]).tobytes() + zlib.compress(steps.astype("<i1" if small else "<i4").tobytes(), 1)
        blocks.append({"least": int(part.min()), "counts": (b"\1" if small else b"\4") + raw})
    return blocks


def unpack_counts(block: bytes) -> np.ndarray:
    """The counts of one block."""
    steps = np.frombuffer(zlib.decompress(block[5:]), "<i1" if block[0] == 1 else "<i4")
    first = int.from_bytes(block[1:5], "little", signed=True)
    return np.concatenate([[first], first + np.cumsum(steps, dtype=np.int64)])


def prefix_store(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``blocks``: the exact token count of every prefix.

    A text of n code points has n + 1 prefixes, the empty one first.
    """

    def make():
        counter = PrefixCounter(path)
        return lambda texts: {"blocks": [pack_counts(counter.every(t or "")) for t in texts]}

    return text_stage(docs, text, "blocks array<struct<least: int, counts: binary>>", make)


def truncate_stored(stored: DataFrame, limit: int) -> DataFrame:
    """The columns of a stored table but ``blocks``, with ``kept_chars`` and ``kept_tokens``.

    They tell the longest prefix of at most ``limit`` tokens. A longer prefix may have fewer tokens
    than a shorter one, so the last block with a count within the limit is the one to read.
    """
    if limit < 0:
        raise ValueError("a prefix has no fewer than 0 tokens")
    number = F.array_max(F.transform("blocks", lambda b, i: F.when(b["least"] <= limit, i)))
    found = stored.withColumn("kept_chars", number.cast("long") * BLOCK).withColumn("_counts", F.get("blocks", number)["counts"])

    def make():
        def work(blocks):
            counts = [unpack_counts(b) for b in blocks]
            last = [int(np.flatnonzero(c <= limit)[-1]) for c in counts]
            return {"_offset": last, "kept_tokens": [int(c[k]) for c, k in zip(counts, last)]}

        return work

    read = text_stage(found.drop("blocks"), "_counts", "_offset long, kept_tokens long", make)
    return read.withColumn("kept_chars", F.col("kept_chars") + F.col("_offset")).drop("_offset")


def count_at(stored: DataFrame, position: Column, name: str = "tokens_at") -> DataFrame:
    """The columns of a stored table but ``blocks``, with the token count of the prefix of ``position`` code points.

    A position beyond the text is its end, one below 0 its start; a null one has a null count.
    """
    at = F.greatest(position.cast("long"), F.lit(0).cast("long"))
    block = F.least(F.floor(at / BLOCK), F.size("blocks") - 1).cast("int")
    offset = F.least(at - block * F.lit(BLOCK), F.lit(BLOCK).cast("long"))
    asked = F.when(position.isNotNull(), F.concat(F.unhex(F.lpad(F.hex(offset), 8, "0")), F.get("blocks", block)["counts"]))

    def make():
        def one(payload):
            if payload is None:
                return None
            counts = unpack_counts(payload[4:])
            return int(counts[min(int.from_bytes(payload[:4], "big"), len(counts) - 1)])

        return lambda payloads: {name: [one(p) for p in payloads]}

    return text_stage(stored.withColumn("_asked", asked).drop("blocks"), "_asked", f"`{name}` long", make)


def truncate(docs: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """``docs`` but ``text`` with ``kept_chars`` and ``kept_tokens``: the longest prefix within ``limit`` tokens."""
    return truncate_stored(prefix_store(docs, path, text), limit)


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = prefix_table(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return counted.select(
        "doc_id", "n_bytes", tokens().alias("n_tokens"), (tokens() > 512).alias("over_limit")
    )
