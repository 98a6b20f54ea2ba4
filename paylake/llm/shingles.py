"""Sets of word n-grams as sorted 64-bit hashes, computed on arrays of bytes."""

from __future__ import annotations

import functools

import numpy as np

from paylake.llm.pretokens import groups, powers

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _letters() -> np.ndarray:
    """A number of 64 bits for each byte, of a lower-cased text."""
    return mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))[_LOWER]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, A-Z in lower case, and where each text's words end."""
    raw = [t.encode() for t in texts]
    byte = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    n = len(byte)
    up, down = powers(n)
    blank = _BLANK[byte]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    begin, stop = edge[0::2], edge[1::2]
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_letters()[byte] * up[:n], out=total[1:])
    hashes = mixed((total[stop] - total[begin]) * down[begin] + (stop - begin).astype(np.uint64))
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    return hashes, np.searchsorted(begin, ends)


def shingle_sets(texts: list[str], k: int):
    """Sorted distinct hashes of each text's runs of k words; a shorter text is one run."""
    for run in groups(texts):
        words, ends = word_hashes(run)
        grams = words
        for j in range(1, k):
            grams = mixed(grams[: len(words) - j] * np.uint64(0xD6E8FEB86659FD93) + words[j:])
        for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
            if b - a >= k:
                yield np.unique(grams[a:b - k + 1])
            elif b > a:
                whole = words[a:a + 1]
                for j in range(a + 1, b):
                    whole = mixed(whole * np.uint64(0xD6E8FEB86659FD93) + words[j:j + 1])
                yield whole
            else:
                yield words[:0]
