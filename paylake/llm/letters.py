"""Words as runs of letters, for many texts at once, without cutting one out.

A group of texts is one array of lower-case code points. A polynomial hash of every stretch of it
comes from two look-ups, so words, their beginnings and all their substrings have hashes at once.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

from paylake.llm.pretokens import L, classes, groups, powers
from paylake.llm.shingles import mixed

GROUP = 1 << 20  # characters held at a time


@functools.cache
def _numbers() -> np.ndarray:
    return mixed((np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def running(cps: np.ndarray) -> np.ndarray:
    """Running sums from which every stretch of code points has its hash."""
    total = np.zeros(len(cps) + 1, np.uint64)
    np.cumsum(_numbers()[cps] * powers(len(cps))[0][:len(cps)], out=total[1:])
    return total


def between(total: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of each stretch; equal stretches have equal hashes wherever they lie."""
    return (total[stop] - total[begin]) * powers(len(total))[1][begin] + (stop - begin).astype(np.uint64)


@dataclass
class Words:
    """Runs of letters of a group of texts; ``ends``: how many there are up to each text's end."""

    cps: np.ndarray
    total: np.ndarray
    begin: np.ndarray
    stop: np.ndarray
    ends: np.ndarray
    stops: np.ndarray  # positions of the texts' ends

    def hashes(self, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return between(self.total, begin, stop)

    def owner(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.ends)), np.diff(self.ends, prepend=0))


def hash_of(word: str) -> int:
    """The hash of one stretch."""
    return int(next(words([word + " "])).hashes(np.array([0]), np.array([len(word)]))[0])


def words(texts: list[str], longest: int = 0):
    """The words of the texts, group by group; a longer run than ``longest`` is taken in parts."""
    for run in groups(texts, GROUP):
        lower = [t.lower() for t in run]
        cps = np.frombuffer((" ".join(lower) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = classes()[cps] == L
        edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
        if letter[0]:
            edge = np.concatenate([[0], edge])
        begin, stop = edge[0::2], edge[1::2]
        if longest and len(begin) and (stop - begin).max() > longest:
            parts = -(-(stop - begin) // longest)
            nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            limit = np.repeat(stop, parts)
            begin = np.repeat(begin, parts) + nth * longest
            stop = np.minimum(begin + longest, limit)
        stops = np.cumsum(np.fromiter(map(len, lower), np.int64, len(lower)) + 1) - 1
        yield Words(cps, running(cps), begin, stop, np.searchsorted(begin, stops), stops)
