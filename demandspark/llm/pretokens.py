r"""Pre-token boundaries of byte-level BPE without running a regular expression over the text.

The pattern ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``
is an automaton of eight states over eight symbols. A symbol is a code point's class with
what follows it already folded in (does a contraction follow the apostrophe, does a
non-space follow the space). One code point maps every state to a state; such maps
compose associatively, so the texts of a whole batch are laid out as rows of a grid, the
rows' maps are built side by side, scanned by doubling, and each row is then run from its
true entry state. Three passes of array look-ups give all boundaries.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

LETTER, NUMBER, OTHER, APOSTROPHE_2, APOSTROPHE_3, BLANK, SPACE_LAST, BLANK_LAST = range(8)
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, JOINING, IN_BLANKS, ONE_LEFT, TWO_LEFT = range(8)
_IDENTITY = 16  # symbols from 8 on: the same at the first code point of a text; 16: padding
_WIDTH = 128


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, does a pre-token start here) by symbol and state."""
    after = np.zeros((17, 8), np.uint8)
    starts = np.zeros((17, 8), bool)
    run_of = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}
    for state in range(8):
        for symbol in range(8):
            if state in (ONE_LEFT, TWO_LEFT):  # inside a contraction
                after[symbol, state] = ONE_LEFT if state == TWO_LEFT else FRESH
            elif symbol in (BLANK, SPACE_LAST, BLANK_LAST):
                starts[symbol, state] = symbol != BLANK or state != IN_BLANKS
                after[symbol, state] = {BLANK: IN_BLANKS, SPACE_LAST: JOINING, BLANK_LAST: FRESH}[symbol]
            else:
                run = run_of.get(symbol, IN_OTHER)
                starts[symbol, state] = state not in (JOINING, run)
                after[symbol, state] = run
                if symbol in (APOSTROPHE_2, APOSTROPHE_3) and starts[symbol, state]:
                    after[symbol, state] = ONE_LEFT if symbol == APOSTROPHE_2 else TWO_LEFT
    after[8:16], starts[8:16] = after[:8, [FRESH]], starts[:8, [FRESH]]
    after[_IDENTITY] = np.arange(8)
    return after.ravel(), starts.ravel()


_AFTER, _STARTS = _automaton()


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """LETTER, NUMBER, OTHER or BLANK of every code point, as the tokenizer library sees it."""
    import tiktoken

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        members = bytes(probe.encode_ordinary(every)).decode()
        table[codepoints(members)] = kind
    return table


def is_blank(char: str) -> bool:
    return class_table()[ord(char)] == BLANK


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _symbols(codes: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Class of each code point with its look-ahead folded in; ``first`` marks text starts."""
    n = len(codes)
    kind = table[codes]
    symbols = kind.copy()
    blank = kind == BLANK
    ends_run = np.zeros(n, bool)
    ends_run[:-1] = blank[:-1] & ~blank[1:] & ~first[1:]
    symbols[ends_run] = BLANK_LAST
    symbols[ends_run & (codes == 0x20)] = SPACE_LAST

    at = np.flatnonzero(codes == 0x27)
    if len(at):
        padded = np.concatenate([codes, np.zeros(2, np.uint32)])
        edge = np.concatenate([first, np.ones(2, bool)])
        one, two = padded[at + 1], padded[at + 2]
        here, both = ~edge[at + 1], ~edge[at + 1] & ~edge[at + 2]
        short = here & np.isin(one, [ord(c) for c in "stmd"])
        long = both & (
            ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        )
        symbols[at[short]] = APOSTROPHE_2
        symbols[at[long]] = APOSTROPHE_3
    symbols[first] += 8
    return symbols


def boundaries(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions in ``codes`` where pre-tokens start; ``first`` marks where texts start."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    rows = -(-n // _WIDTH)
    grid = np.full(rows * _WIDTH, _IDENTITY, np.uint8)
    grid[:n] = _symbols(codes, first, class_table())
    by_step = np.ascontiguousarray(grid.reshape(rows, _WIDTH).T).astype(np.int16) * 8

    maps = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for step in by_step:
        maps = _AFTER.take(step[:, None] + maps)
    shift = 1
    while shift < rows:  # prefix compositions by doubling: later map after earlier map
        maps[shift:] = np.take_along_axis(maps[shift:], maps[:-shift].copy(), axis=1)
        shift *= 2

    state = np.full(rows, FRESH, np.uint8)
    state[1:] = maps[:-1, FRESH]
    out = np.empty((_WIDTH, rows), bool)
    for i, step in enumerate(by_step):
        at = step + state
        out[i] = _STARTS.take(at)
        state = _AFTER.take(at)
    return np.flatnonzero(out.T.ravel()[:n])


def split(texts: list[str]) -> list[tuple[list[str], np.ndarray]]:
    """(pre-tokens, their starts) of each text."""
    joined = "".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    first = np.zeros(len(joined), bool)
    first[begins[begins < ends]] = True
    starts = boundaries(codepoints(joined), first)
    cuts = [*starts.tolist(), len(joined)]
    pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
    low = np.searchsorted(starts, begins).tolist()
    high = np.searchsorted(starts, ends).tolist()
    return [(pieces[a:b], starts[a:b] - o) for a, b, o in zip(low, high, begins)]
