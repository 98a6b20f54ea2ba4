"""Pre-token boundaries of byte-level BPE, from character classes and a scan of transition functions.

The split is the one of the public byte-BPE pattern: contractions, letters, numbers and other
characters with an optional leading space, white space. No regular expression runs on a text.
Every character becomes a symbol by a class array over all code points. A symbol is a function
on the eight states below; functions compose associatively, and the few that can arise are
numbered, so a prefix scan over a block is a chain of table look-ups on whole columns, and
blocks, windows and documents join by one more composition.
"""

from __future__ import annotations

import base64
import functools

import numpy as np

# Symbols. QUOTE opens a possible contraction, of which MIDDLE and LAST are the letters.
L, N, P, SPACE, WHITE, QUOTE, MIDDLE, LAST, END = range(9)
# States: what the character just read belongs to. OPEN: a contraction; CLOSED: its last letter.
START, IN_L, IN_N, IN_P, AFTER_SPACE, AFTER_WHITE, OPEN, CLOSED = range(8)
STATES, SYMBOLS = 8, 9
BLOCK = 128
WINDOW = 1 << 20  # characters that one scan holds

# The contractions of the pattern.
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")


def _next(state: int, symbol: int) -> int:
    if symbol == END:
        return START
    if symbol == QUOTE:
        return IN_P if state in (IN_P, AFTER_SPACE) else OPEN
    if symbol == MIDDLE:
        return OPEN if state == OPEN else IN_L
    if symbol == LAST:
        return CLOSED if state == OPEN else IN_L
    return (IN_L, IN_N, IN_P, AFTER_SPACE, AFTER_WHITE)[symbol]


def _opens(state: int, symbol: int) -> bool:
    """Whether a pre-token begins at a symbol read in a state, white space before text apart."""
    if symbol == END or state in (START, CLOSED):
        return True
    if state == OPEN:
        return False
    if symbol in (SPACE, WHITE):
        return state not in (AFTER_SPACE, AFTER_WHITE)
    if state == AFTER_SPACE:
        return False
    return state != {L: IN_L, MIDDLE: IN_L, LAST: IN_L, N: IN_N, P: IN_P, QUOTE: IN_P}[symbol]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Function number of each symbol, composition, application, openings, number of functions."""
    symbols = [tuple(_next(s, y) for s in range(STATES)) for y in range(SYMBOLS)]
    number = {tuple(range(STATES)): 0}
    found = list(number)
    for f in found:  # grows while it is read: closure under composition
        for g in symbols:
            h = tuple(g[s] for s in f)
            if h not in number:
                number[h] = len(found)
                found.append(h)
    m = len(found)
    compose = np.array([[number[tuple(g[s] for s in f)] for g in found] for f in found], np.uint8)
    apply = np.array(found, np.uint8)
    opens = np.array([[_opens(s, y) for y in range(SYMBOLS)] for s in range(STATES)])
    return np.array([number[f] for f in symbols], np.uint8), compose.ravel(), apply, opens, m


def _prefixes(f: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of function numbers."""
    _, compose, _, _, m = _tables()
    n = len(f)
    if n <= BLOCK:
        out = f.copy()
        for i in range(1, n):
            out[i] = compose[int(out[i - 1]) * m + int(out[i])]
        return out
    rows = -(-n // BLOCK)
    padded = np.zeros(rows * BLOCK, np.uint8)
    padded[:n] = f
    g = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    for j in range(1, BLOCK):
        g[j] = compose[g[j - 1].astype(np.intp) * m + g[j]]
    before = np.zeros(rows, np.intp)
    before[1:] = _prefixes(g[-1])[:-1]
    return compose[(before * m)[None, :] + g].T.reshape(-1)[:n]


def states(symbols: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """State before each symbol, and after the last one, when reading begins in ``state``."""
    number, _, apply, _, _ = _tables()
    after = apply[_prefixes(number[symbols]), state]
    return np.concatenate([np.array([state], np.uint8), after[:-1]]), int(after[-1])


def boundaries(joined: str, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Positions in ``joined`` where pre-tokens begin.

    ``joined`` holds texts with one character after each; ``ends`` has the ascending positions of
    those characters, which are boundaries themselves.
    """
    found, state, size = [], START, len(joined)
    opens = _tables()[3]
    b = 0
    while b < size:
        a, b = b, min(b + WINDOW, size)
        while b < size and "'" in joined[b - 2:b]:  # no contraction lies across two windows
            b += 1
        cps = np.frombuffer(joined[a:b + 2].encode("utf-32-le"), np.uint32)
        symbols = table[cps]
        marks = ends[np.searchsorted(ends, a):np.searchsorted(ends, b + 2)] - a
        symbols[marks] = END
        quotes = np.flatnonzero(cps[: b - a] == ord("'"))
        if len(quotes):
            ahead = np.concatenate([cps, np.zeros(2, np.uint32)])
            ahead[marks] = 0
            one, two = ahead[quotes + 1], ahead[quotes + 2]
            short = np.isin(one, [ord(c) for c in ONE_LETTER])
            symbols[quotes[short]] = QUOTE
            symbols[quotes[short] + 1] = LAST
            for first, second in TWO_LETTERS:
                long = quotes[(one == ord(first)) & (two == ord(second))]
                symbols[long], symbols[long + 1], symbols[long + 2] = QUOTE, MIDDLE, LAST
        here = symbols[: b - a]
        before, state = states(here, state)
        begins = opens[before, here]
        follow = np.full(b - a, END, np.uint8)
        rest = symbols[1: b - a + 1]
        follow[: len(rest)] = rest
        blank = (here == SPACE) | (here == WHITE)
        begins |= blank & (follow != SPACE) & (follow != WHITE) & (follow != END)
        found.append(np.flatnonzero(begins) + a)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def groups(texts: list[str], size: int = WINDOW):
    """Runs of texts that hold about ``size`` characters; a longer text stands alone."""
    run, held = [], 0
    for t in texts:
        if run and held + len(t) > size:
            yield run
            run, held = [], 0
        run.append(t)
        held += len(t) + 1
    if run:
        yield run


def cuts(texts: list[str], table: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 of all texts with a zero byte after each, where pre-tokens and those bytes begin, and
    which of these beginnings are the ends of the texts."""
    joined = "\0".join(texts) + "\0"
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    at = boundaries(joined, ends, table)
    last = np.searchsorted(at, ends)
    raw = joined.encode()
    if len(raw) != len(joined):  # byte offsets of the boundaries
        byte = np.frombuffer(raw, np.uint8)
        at = np.flatnonzero((byte & 0xC0) != 0x80)[at]
    return raw, at, last


def _scrambled(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    base, found = 0x9E3779B97F4A7C15, []
    for factor in (base, pow(base, -1, 1 << 64)):
        row = np.full(n + 1, factor, np.uint64)
        row[0] = 1
        found.append(np.cumprod(row))
    return found[0], found[1]


_powers = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers and inverse powers, from one table for all kinds of hashes of a worker."""
    global _powers
    if len(_powers[0]) <= n:
        _powers = _scrambled(max(n + n // 4, WINDOW + WINDOW // 4))
    return _powers


def distinct(texts: list[str], table: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct pre-tokens, the number of each pre-token's in text order, and the texts' ends.

    A polynomial hash finds equal pre-tokens without cutting each one out. The texts are then put
    together again from the distinct ones and compared, so two pre-tokens of one hash are noticed;
    the pre-tokens are then cut out and compared themselves. A zero byte stands after each text.
    """
    raw, at, last = cuts(texts, table)
    n = len(raw)
    up, down = powers(n)
    byte = np.frombuffer(raw, np.uint8)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((byte.astype(np.uint64) + np.uint64(0x51ED270B)) * up[:n], out=total[1:])
    stop = np.append(at[1:], n)
    _, first, which = np.unique((total[stop] - total[at]) * down[at] + (stop - at).astype(np.uint64), return_index=True, return_inverse=True)
    begin, size = at[first], (stop - at)[first]
    back = np.repeat(begin[which] - at, stop - at)
    back += np.arange(n)
    if not (size[which] == stop - at).all() or not (byte[np.minimum(back, n - 1)] == byte).all():
        found = [raw[a:b] for a, b in zip(at.tolist(), stop.tolist())]
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(p, len(number)) for p in found])
        return list(number), which, last
    return [raw[a:b] for a, b in zip(begin.tolist(), (begin + size).tolist())], which, last


def spread(ids: list[bytes], which: np.ndarray, last: np.ndarray) -> list[bytes]:
    """Id bytes of each text from those of the distinct pre-tokens."""
    count = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat = np.frombuffer(b"".join(ids), "<u4")
    begin = np.cumsum(count) - count
    own = count[which]
    own[last] = 0  # the bytes between the texts
    place = np.cumsum(own)
    out = flat[np.repeat(begin[which] - (place - own), own) + np.arange(place[-1])].tobytes()
    stops = (place[last] * 4).tolist()
    return [out[a:b] for a, b in zip([0, *stops], stops)]


def _classes(letters: str, numbers: str, white: str) -> np.ndarray:
    out = np.full(0x110000, P, np.uint8)
    for symbol, chars in ((L, letters), (N, numbers), (WHITE, white)):
        out[np.frombuffer(chars.encode("utf-32-le"), np.uint32)] = symbol
    out[ord(" ")] = SPACE
    return out


def _all_characters() -> str:
    return "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


@functools.cache
def classes() -> np.ndarray:
    """Classes as the rank library sees them: it keeps the characters that a pattern matches."""
    import tiktoken

    alphabet, table = _all_characters(), {bytes([i]): i for i in range(256)}

    def matched(pattern: str) -> str:
        e = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        return e.decode_bytes(e.encode_ordinary(alphabet)).decode()

    return _classes(matched(r"\p{L}"), matched(r"\p{N}"), matched(r"\s"))


@functools.cache
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
