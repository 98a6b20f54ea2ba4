"""Ids of the pre-tokens that a worker has met, found for a whole column of them at once.

A pre-token of at most SHORT bytes is two 64-bit words, its bytes and its length, so equal words are
equal pre-tokens and nothing rests on a hash. The words lie in a table of open addressing, which is
probed and filled by whole columns; texts are neither cut into pre-tokens nor are these sorted. Longer
pre-tokens are few for their bytes and go through a dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

SHORT = 15  # bytes of a pre-token that two words hold beside its length
CACHE = 1 << 20  # short pre-tokens a worker keeps, about 45 MB; the table has two places for each
LONGEST = 200  # bytes of a longer pre-token that is kept
LONG_CACHE = 16 << 20  # bytes of longer ones, of their ids and of OVERHEAD each, in each of two generations
OVERHEAD = 200

_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LOW = _MASK[np.minimum(np.arange(SHORT + 1), 8)]
_HIGH = _MASK[np.maximum(np.arange(SHORT + 1) - 8, 0)]
_SIZE = np.arange(SHORT + 1, dtype=np.uint64) << np.uint64(56)


def words(raw: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both words of the pre-tokens of ``size`` bytes, at most SHORT, that lie at ``at``."""
    eight = np.ndarray((len(raw) + 9,), "<u8", raw + bytes(16), strides=(1,))
    return eight[at] & _LOW[size], eight[at + 8] & _HIGH[size] | _SIZE[size]


class Known:
    """``ask`` gives all ids of a list of distinct pre-tokens, and how many each one has."""

    def __init__(self, ask: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.ask = ask
        self.bits = (2 * CACHE - 1).bit_length()
        self.slot = np.zeros(1 << self.bits, np.int32)  # one more than the number of what is kept there
        self.held = 0
        self.low, self.high = np.zeros(CACHE, np.uint64), np.zeros(CACHE, np.uint64)
        self.begin, self.count = np.zeros(CACHE, np.int32), np.zeros(CACHE, np.uint8)
        self.used = np.zeros(CACHE, bool)  # met again since the last clearing
        self.ids, self.end = np.zeros(1 << 16, np.int32), 0
        self.long: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.weight = 0

    def _place(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ high * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.intp)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Number of each pre-token, -1 where it is not kept."""
        at = self._place(low, high)
        found = self.slot[at] - 1
        open_ = np.flatnonzero((found >= 0) & ((self.low[found] != low) | (self.high[found] != high)))
        while len(open_):
            at[open_] = at[open_] + 1 & len(self.slot) - 1
            here = self.slot[at[open_]] - 1
            found[open_] = here
            open_ = open_[(here >= 0) & ((self.low[here] != low[open_]) | (self.high[here] != high[open_]))]
        return found

    def _fill(self, first: int) -> None:
        """Gives the kept ones from ``first`` on their places; of several at one place all but one go on."""
        number = np.arange(first, self.held, dtype=np.int32)
        at = self._place(self.low[first:self.held], self.high[first:self.held])
        while len(number):
            free = self.slot[at] == 0
            self.slot[at[free]] = number[free] + 1
            lost = self.slot[at] != number + 1
            number, at = number[lost], at[lost] + 1 & len(self.slot) - 1

    def _clear(self) -> None:
        """Forgets what was not met again since the last time, or all but the newer half of the places."""
        kept = np.flatnonzero(self.used[:self.held])[-(len(self.low) // 2):]
        count = self.count[kept].astype(np.intp)
        stop = np.cumsum(count)
        ids = self.ids[np.repeat(self.begin[kept] - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)]
        self.held, self.end = len(kept), len(ids)
        self.ids[:self.end] = ids
        for column, values in ((self.low, self.low[kept]), (self.high, self.high[kept]), (self.begin, stop - count), (self.count, count)):
            column[:self.held] = values
        self.used[:] = False
        self.slot[:] = 0
        self._fill(0)

    def _put(self, ids: np.ndarray, at: int) -> int:
        if at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:at], np.zeros(at + 2 * len(ids), np.int32)])
        self.ids[at:at + len(ids)] = ids
        return at + len(ids)

    def _short(self, raw: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Where in ``ids`` those of each short pre-token begin, how many they are, and where ``ids``
        are free. New ones without room here serve this once."""
        low, high = words(raw, at, size)
        found = self.find(low, high)
        new = np.flatnonzero(found < 0)
        if not len(new):
            self.used[found] = True
            return self.begin[found].astype(np.intp), self.count[found].astype(np.intp), self.end
        self.used[found[found >= 0]] = True
        new = new[np.lexsort((low[new], high[new]))]
        differs = np.append(True, (np.diff(low[new]) != 0) | (np.diff(high[new]) != 0))
        one = new[differs]
        ids, count = self.ask([raw[a:b] for a, b in zip(at[one].tolist(), (at[one] + size[one]).tolist())])
        free, stop = self._put(ids, self.end), self.end + np.cumsum(count)
        begins, counts = self.begin[found].astype(np.intp), self.count[found].astype(np.intp)
        which = np.cumsum(differs) - 1
        begins[new], counts[new] = (stop - count)[which], count[which]
        first, kept = self.held, min(len(one), len(self.low) - self.held)
        if kept:
            self.held, self.end = first + kept, int(stop[kept - 1])
            for column, values in ((self.low, low[one]), (self.high, high[one]), (self.begin, stop - count), (self.count, count)):
                column[first:self.held] = values[:kept]
            self._fill(first)
        return begins, counts, free

    def _long(self, pieces: list[bytes], free: int) -> tuple[np.ndarray, np.ndarray]:
        """The same for longer pre-tokens; their ids are put where ``ids`` are free."""
        number: dict[bytes, int] = {}
        which = np.array([number.setdefault(p, len(number)) for p in pieces], np.intp)
        made = {p: x for p in number if p not in self.long and (x := self.older.get(p)) is not None}
        new = [p for p in number if p not in self.long and p not in made]
        ids, count = self.ask(new)
        flat, stops = ids.tobytes(), (4 * np.cumsum(count)).tolist()
        made.update((p, flat[a:b]) for p, a, b in zip(new, [0, *stops], stops))
        found = [made[p] if p in made else self.long[p] for p in number]
        for p, x in made.items():
            if len(p) <= LONGEST:
                self.long[p] = x
                self.weight += OVERHEAD + len(p) + len(x)
        if self.weight > LONG_CACHE:
            self.long, self.older, self.weight = {}, self.long, 0
        count = np.fromiter(map(len, found), np.intp, len(found)) // 4
        begin = free + np.cumsum(count) - count
        self._put(np.frombuffer(b"".join(found), np.int32), free)
        return begin[which], count[which]

    def ids_of(self, raw: bytes, at: np.ndarray, last: np.ndarray) -> Iterator[bytes]:
        """Id bytes of each text, from what ``pretokens.cuts`` gives."""
        if self.held > len(self.low) - len(self.low) // 8:
            self._clear()
        size = np.diff(at, append=len(raw))
        short = size <= SHORT
        begin, count = np.zeros(len(at), np.intp), np.zeros(len(at), np.intp)
        short[last] = False  # the bytes between the texts
        begin[short], count[short], free = self._short(raw, at[short], size[short])
        long = ~short
        long[last] = False
        if long.any():
            a, b = at[long], (at + size)[long]
            begin[long], count[long] = self._long([raw[i:j] for i, j in zip(a.tolist(), b.tolist())], free)
        place = np.cumsum(count)
        out = self.ids[np.repeat(begin - (place - count), count) + np.arange(place[-1])].tobytes()
        stops = (place[last] * 4).tolist()
        for a, b in zip([0, *stops], stops):
            yield out[a:b]
