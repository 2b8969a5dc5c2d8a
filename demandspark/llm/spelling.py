r"""Operator 13: spelling variants by a variable-length gram index.

1. Vocabulary: words and their numbers, counted within each task before the shuffle.
2. Gram dictionary, pruned by frequency: the grams of MIN_GRAM to MAX_GRAM characters that
   more than a threshold of words have. The threshold grows with the vocabulary so that the
   dictionary has at most DICTIONARY entries, which is what every task is given.
3. Decomposition: from each place of a word (with a mark at both ends) the shortest gram
   that is not frequent, or MAX_GRAM characters. A gram depends on its own characters
   alone, so an edit affects only the grams that cover it. The largest number of grams over
   one character is the word's affected-gram bound b.
4. Lists: words at distance one keep all but b grams, at the same place or one further. The
   first kept gram in the order (frequency, gram, place) is among the first b + 1 of both
   words, so only these b + 1 lists are merged; a list is named by gram, place and length,
   and a word visits the lists of the words one longer.
5. A list above ``LIST`` rows is cut by the first and by the last half of its words: one
   edit leaves one of them alone. No list, and no letter combination, is bound to one task.
6. Pairs of a list are verified in blocks, an edit in or out or one letter replaced.
7. Forms and roots: the most frequent near word, followed by pointer doubling.

Since b <= MAX_GRAM and a word of MIN_CHARS characters has MIN_CHARS + 1 grams, at least one
gram is kept as long as MAX_GRAM <= MIN_CHARS; no word needs another way.

Words are maximal runs of ``[A-Za-zÀ-ÿ]``; only A-Z is lower-cased. Defined cases:
null and empty texts have no words; very long runs are words like any other; ties of the
most frequent near word go to the smallest in code-point order; repeated rows count each;
a null id counts as an empty one in the damage rule; an empty table gives an empty table.
Only the id and the text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import arrow_stage, partition_count, table
from demandspark.llm.registry import query
from demandspark.staging import staged

MIN_CHARS, MIN_COUNT = 6, 5
MIN_GRAM, MAX_GRAM = 2, 6
DICTIONARY = 1 << 16
MIN_FREQUENT = 32
LIST = 512
DAMAGE = 199
_HELD = 200_000
_PAIRS = 1 << 17
_WIDE = 64
# Latin-1 letters stay, A-Z become small, all else is a blank.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


def damaged(word: bytes, start: int, damage: int) -> bytes:
    """``word`` (Latin-1) less one character where ``damage`` divides its checksum; ``start`` is that of the id."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    if h % damage:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(text: str, doc_id, min_chars: int, damage: int | None) -> Counter:
    """Words (Latin-1) of one text with their numbers."""
    found = Counter(text.encode("latin-1", "replace").translate(_LETTERS).split())
    long = [(w, n) for w, n in found.items() if len(w) >= min_chars]
    if damage is None:
        return Counter(dict(long))
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out = Counter()
    for word, n in long:
        word = damaged(word, start, damage)
        if len(word) >= min_chars:
            out[word] += n
    return out


def _counted(counts: Counter, name: str, decode: bool = False) -> pa.RecordBatch:
    words = [w.decode("latin-1") for w in counts] if decode else list(counts)
    return pa.RecordBatch.from_pydict({name: pa.array(words, pa.string()), "n": pa.array(counts.values(), pa.int64())})


def vocabulary(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT, damage: int | None = None,
) -> DataFrame:
    """``word`` and ``n`` of the words with at least ``min_chars`` characters and ``min_count`` occurrences.

    With ``damage`` a word loses a character in documents where ``damage`` divides the
    checksum of id and word: planted misspellings to measure the operator by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if value := value.as_py():
                    counts.update(word_counts(value, doc_id, min_chars, damage))
                if len(counts) >= _HELD:
                    yield _counted(counts, "word", decode=True)
                    counts = Counter()
        yield _counted(counts, "word", decode=True)

    rows = arrow_stage(docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")), run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def gram_dictionary(words: DataFrame, entries: int = DICTIONARY, least: int = MIN_FREQUENT) -> dict[str, int]:
    """Number of places of each frequent gram; at most ``entries`` of them.

    All places of grams together are at most ``places``, and each entry takes more than the
    threshold of them.
    """
    places = words.agg(F.sum(F.length("word") + 2)).first()[0] or 0
    most = max(least, -(-places * (MAX_GRAM - MIN_GRAM + 1) // entries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                for a in range(0, len(word) + 2, _HELD):  # a very long word in parts
                    marked = f"^{word}$"[a : a + _HELD + MAX_GRAM - 1]
                    for k in range(MIN_GRAM, MAX_GRAM + 1):
                        counts.update(marked[i : i + k] for i in range(min(_HELD, len(marked) - k + 1)))
                    if len(counts) >= _HELD:
                        yield _counted(counts, "gram")
                        counts = Counter()
        yield _counted(counts, "gram")

    grams = arrow_stage(words.select("word"), run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in grams.where(F.col("n") > most).collect()}


def decompose(word: str, frequent: dict[str, int]) -> list[str]:
    """The variable gram from each place of the marked word."""
    marked = f"^{word}$"
    grams = []
    for p in range(len(marked) - MIN_GRAM + 1):
        k = MIN_GRAM
        gram = marked[p : p + k]
        while k < MAX_GRAM and p + k < len(marked) and gram in frequent:
            k += 1
            gram = marked[p : p + k]
        grams.append(gram)
    return grams


def affected_bound(grams: list[str]) -> int:
    """Most grams that one edit can touch: those over one character."""
    cover = np.zeros(len(grams) + MAX_GRAM + 1, np.int32)
    starts = np.arange(len(grams))
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + np.fromiter(map(len, grams), np.int64, len(grams)), -1)
    return int(np.cumsum(cover).max())


def first_lists(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, place) of the lists that the word stands in."""
    grams = decompose(word, frequent)
    ordered = sorted((frequent.get(g, 0), g, p) for p, g in enumerate(grams))
    return [(g, p) for _, g, p in ordered[: affected_bound(grams) + 1]]


def _lists(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(list, host, size, word, n): each word as host in its lists and as visitor in those of longer words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        name = xxhash.xxh3_64_intdigest
        for batch in batches:
            lists, host, size, word, n = [], [], [], [], []
            for w, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = []
                for gram, p in first_lists(w, frequent):
                    keys += [(gram, len(w), p), (gram, len(w) + 1, p), (gram, len(w) + 1, p + 1)]
                lists += [name(f"{g}:{length}:{p}") for g, length, p in keys]
                host += [length == len(w) for _, length, _ in keys]
                size += [length for _, length, _ in keys]
                word += [w] * len(keys)
                n += [k] * len(keys)
            yield pa.RecordBatch.from_pydict({
                "list": pa.array(np.array(lists, np.uint64).view(np.int64)), "host": pa.array(host, pa.bool_()),
                "size": pa.array(size, pa.int32()), "word": pa.array(word, pa.string()), "n": pa.array(n, pa.int64()),
            })

    return arrow_stage(words.select("word", "n"), run, "list long, host boolean, size int, word string, n long")


def _cut(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (staged) with each list of more than ``limit`` rows cut by halves of its words; lists
    without a host and lists of one are left out."""
    shape = rows.groupBy("list").agg(F.count("*").alias("rows"), F.count_if("host").alias("hosts"))
    shape = staged(shape.where("rows > 1 AND hosts > 0").select("list", (F.col("rows") > limit).alias("large")), "lists")
    half = F.floor((F.col("size") - 1) / 2).cast("int")
    part = F.explode(F.when(F.col("large"), F.array(
        F.xxhash64("list", F.lit(0), F.substring("word", F.lit(1), half)),
        F.xxhash64("list", F.lit(1), F.right("word", half)),
    )).otherwise(F.array("list")))
    return rows.join(shape, "list").select(part.alias("list"), "host", "word", "n")


def near(a: bytes, b: bytes) -> bool:
    """Whether exactly one character in, out or replaced turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and len(b) - len(a) <= 1 and a[p + (len(a) == len(b)) :] == b[p + 1 :]


def near_pairs(words: list[bytes], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``near`` of many pairs (indices into ``words``), the left word as long or one shorter."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros(len(left), bool)
    wide = sizes[right] > _WIDE
    for i in np.flatnonzero(wide):
        out[i] = near(words[left[i]], words[right[i]])
    slim = [w if len(w) <= _WIDE else b"" for w in words]
    width = max(1, max(map(len, slim), default=1))
    ahead = np.array(slim, f"S{width}").view(np.uint8).reshape(-1, width)
    back = np.array([w[::-1] for w in slim], f"S{width}").view(np.uint8).reshape(-1, width)
    at = np.flatnonzero(~wide)
    for a in range(0, len(at), _PAIRS):
        some = at[a : a + _PAIRS]
        x, y = left[some], right[some]
        other = ahead[x] != ahead[y]
        same = sizes[x] == sizes[y]
        hit = same & (other.sum(axis=1) == 1)
        k = np.flatnonzero(~same)
        head = other[k].argmax(axis=1)
        tail = (back[x[k]] != back[y[k]]).argmax(axis=1)
        hit[k] = head + tail >= sizes[x[k]]
        out[some] = hit
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, na, nb) of near words, from rows sorted by list, visitors before hosts."""

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, host = rows["list"].to_numpy(), rows["host"].to_numpy(zero_copy_only=False)
        words = [w.encode("latin-1") for w in rows["word"].to_pylist()]
        n = rows["n"].to_numpy()
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        size = np.diff(np.append(start, len(keys)))
        end = np.repeat(start + size, size)
        first_host = np.repeat(start + size - np.add.reduceat(host.astype(np.int64), start), size)
        begin = np.maximum(np.arange(len(keys)) + 1, first_host)
        count = np.maximum(end - begin, 0)
        upto = np.cumsum(count)
        a = 0
        while a < len(keys):  # as many rows as make a bounded number of pairs
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + 8 * _PAIRS, "right")))
            c = count[a:b]
            left = np.repeat(np.arange(a, b), c)
            right = np.arange(len(left)) + np.repeat(begin[a:b] - np.cumsum(c) + c, c)
            hit = near_pairs(words, left, right)
            a = b
            if not hit.any():
                continue
            x, y = left[hit], right[hit]
            yield pa.RecordBatch.from_pydict({
                "a": rows["word"].take(pa.array(x)).combine_chunks(), "b": rows["word"].take(pa.array(y)).combine_chunks(),
                "na": pa.array(n[x], pa.int64()), "nb": pa.array(n[y], pa.int64()),
            })

    held: pa.Table | None = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        held = part if held is None else pa.concat_tables([held, part])
        if held.num_rows < _HELD:
            continue
        keys = held["list"].to_numpy()
        end = int(np.argmax(keys == keys[-1]))
        if end:
            yield from found(held.slice(0, end).combine_chunks())
            held = held.slice(end)
    if held is not None and held.num_rows:
        yield from found(held.combine_chunks())


def near_words(words: DataFrame, limit: int = LIST, entries: int = DICTIONARY, least: int = MIN_FREQUENT) -> DataFrame:
    """``a``, ``b``, ``na``, ``nb``: each pair of near words of a vocabulary (staged) once, a before b."""
    lists = staged(_lists(words, gram_dictionary(words, entries, least)), "gram-lists")
    dealt = _cut(lists, limit).repartition(partition_count(words.sparkSession), "list").sortWithinPartitions("list", "host")
    pairs = arrow_stage(dealt, _verified, "a string, b string, na long, nb long")
    low = F.col("a") < F.col("b")
    return pairs.select(
        F.when(low, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(low, F.col("b")).otherwise(F.col("a")).alias("b"),
        F.when(low, F.col("na")).otherwise(F.col("nb")).alias("na"), F.when(low, F.col("nb")).otherwise(F.col("na")).alias("nb"),
    ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form), by pointer doubling; a form is more frequent, so there are no rings."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = staged(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if now.where("further IS NOT NULL").isEmpty():
            return now.drop("further")
        now = now.drop("further")


def variants(words: DataFrame, factor: int = 5, **index) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of a vocabulary (staged).

    ``form`` is the most frequent near word if it is at least ``factor`` times as frequent.
    """
    pairs = staged(near_words(words, **index), "near-words")
    ways = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("other"), F.col("na").alias("n"), F.col("nb").alias("m")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("other"), F.col("nb").alias("n"), F.col("na").alias("m")),
    )).alias("w")).select("w.*")
    best = F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    found = ways.groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("own"), best)
    takes = -F.col("best.m") >= factor * F.col("own")
    found = staged(found.select(
        "word", "n_near", F.when(takes, F.col("best.other")).alias("form"), F.when(takes, -F.col("best.m")).alias("form_n")
    ), "forms")
    roots = _roots(staged(found.where("form IS NOT NULL").select("word", "form"), "followed-forms"))
    return words.join(found, "word", "left").join(roots, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n",
        F.coalesce("root", "word").alias("root"),
    )


_ORACLE = r"""
    with recursive runs as (
        select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) as run
        from documents
    ),
    lowered as (
        select id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as r, count(*) as k
        from runs where length(run) >= 6 group by all
    ),
    bytes as (select *, hex(encode(id || ':' || r)) as x from lowered),
    summed as (
        select r, k, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(length(x) // 2), lambda i:
                   ((instr('0123456789ABCDEF', x[2 * i + 1]) - 1) * 16 + instr('0123456789ABCDEF', x[2 * i + 2]) - 1)::ubigint)),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::ubigint)),
                       lambda y, z: xor(y >> 1, 3988292384::ubigint * (y & 1)))), 4294967295::ubigint) as h
        from bytes
    ),
    words as (
        select case when h % 199 = 0 then r[: (h % length(r))::bigint] || r[(h % length(r))::bigint + 2 :] else r end as word,
               sum(k)::bigint as n
        from summed group by 1 having length(word) >= 6 and n >= 5
    ),
    cuts as (select word, n, i, word[: i] || word[i + 2 :] as cut from words, lateral (select unnest(range(length(word))) as i)),
    near as (
        select a.word, a.n, b.word as other, b.n as m from cuts a join cuts b on a.cut = b.cut and a.i = b.i and a.word <> b.word
        union select c.word, c.n, w.word, w.n from cuts c join words w on c.cut = w.word
        union select w.word, w.n, c.word, c.n from cuts c join words w on c.cut = w.word
    ),
    best as (
        select word, count(*) as n_near, first(other order by m desc, other) as other, max(m) as m, any_value(n) as n from near group by word
    ),
    forms as (
        select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 5 * w.n then other end as form, case when m >= 5 * w.n then m end as form_n
        from words w left join best using (word)
    ),
    walk(word, stop, step) as (
        select word, word, 0 from forms
        union all
        select walk.word, f.form, step + 1 from walk join forms f on f.word = walk.stop where f.form is not null
    )
    select word, n, n_near, form, form_n, max_by(stop, step) as root from forms join walk using (word) group by all
"""


@query("op13_spelling_variants", _ORACLE)
def op13_spelling_variants(spark, sf_dir):
    words = staged(vocabulary(table(spark, sf_dir, "documents"), damage=DAMAGE), "vocabulary")
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")
