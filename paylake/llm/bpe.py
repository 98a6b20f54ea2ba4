"""Byte-level BPE encoding and decoding over whole texts.

Pre-tokens come from :mod:`paylake.llm.pretokens`; each goes through pair merging once and is
then found in a cache. A document's ids are little-endian unsigned 32-bit integers in one binary
value, with the byte offset of every token beside them; decoding gathers the vocabulary's bytes
to those offsets.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paylake.llm import pretokens
from paylake.llm.batches import parts
from paylake.llm.workers import ship

CACHE = 250_000  # merged pre-tokens a worker keeps; a full cache starts anew
SHORT = 200  # bytes up to which the lowest pair is looked for in a list, not a heap
WIDTHS = (6, 10, 16, 32, 64, SHORT)  # merged together: pre-tokens of about the same length
_WIDTH = [next(w for w in WIDTHS if n <= w) for n in range(SHORT + 1)]
ROWS = 20_000
NONE = 1 << 60
_FAR = np.int32(2**31 - 1)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank merges first, the leftmost of equal ones."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > SHORT:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i:i + 2], NONE) for i in range(len(piece) - 1)]
    while pairs:
        low = min(pairs)
        if low == NONE:
            break
        i = pairs.index(low)
        parts[i] += parts.pop(i + 1)
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], NONE)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], NONE)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap over linked parts, for pre-tokens of any length."""
    n = len(piece)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1" * n)

    def pair(i: int) -> int:
        j = end[i]
        return ranks.get(piece[i:end[j]], NONE) if j < n else NONE

    heap = [(r, i, end[end[i]]) for i in range(n - 1) if (r := pair(i)) != NONE]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        alive[end[i]] = 0
        end[i] = stop
        if stop < n:
            before[stop] = i
        for k in (before[i], i):
            if k >= 0 and (r := pair(k)) != NONE:
                heapq.heappush(heap, (r, k, end[end[k]]))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class _Pairs:
    """Rank of two adjacent tokens by their ids, in a table with two places for every pair."""

    EMPTY = np.int64(-1)

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        self.bits = max(8, (len(keys) * 4).bit_length())
        self.key = np.full(1 << self.bits, self.EMPTY)
        self.rank = np.full(1 << self.bits, _FAR, np.int32)
        k, v = np.array(keys, np.int64), np.array(values, np.int32)
        self.steps = 0
        while len(k):  # a pair that finds its place taken goes to the next one
            at = self._place(k, self.steps)
            first = np.unique(np.where(self.key[at] == self.EMPTY, at, -1), return_index=True)
            won = first[1][first[0] >= 0]
            self.key[at[won]], self.rank[at[won]] = k[won], v[won]
            lost = np.ones(len(k), bool)
            lost[won] = False
            k, v = k[lost], v[lost]
            self.steps += 1

    def _place(self, k: np.ndarray, step: int) -> np.ndarray:
        mixed = (k.astype(np.uint64) + np.uint64(step)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = self._place(k, 0)
        out = np.where(self.key[at] == k, self.rank[at], _FAR)
        open_ = np.flatnonzero((out == _FAR) & (self.key[at] != self.EMPTY))
        for step in range(1, self.steps):
            if not len(open_):
                break
            at = self._place(k[open_], step)
            hit = self.key[at] == k[open_]
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit & (self.key[at] != self.EMPTY)]
        return out


def merge_all(words: list[bytes], ranks: dict[bytes, int], pairs: _Pairs) -> list[bytes]:
    """Id bytes of many pre-tokens of at most SHORT bytes: a row each, one merge a round."""
    rows, width = len(words), max(map(len, words))
    size = np.fromiter(map(len, words), np.int64, rows)
    single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
    inside = np.arange(width + 1)[None, :] < size[:, None]
    token = np.zeros((rows, width + 1), np.int32)
    token[inside] = single[np.frombuffer(b"".join(words), np.uint8)]
    right = np.broadcast_to(np.arange(1, width + 2), (rows, width + 1)).astype(np.int32)
    left = right - 2
    rank = np.full((rows, width + 1), _FAR, np.int32)
    follows = inside[:, 1:]
    rank[:, :-1][follows] = pairs(token[:, :-1][follows], token[:, 1:][follows])
    live = np.arange(rows)
    while len(live):
        at = rank[live].argmin(1)
        low = rank[live, at]
        more = low != _FAR
        live, at, low = live[more], at[more], low[more]
        if not len(live):
            break
        gone = right[live, at]
        after = right[live, gone]
        token[live, at], rank[live, gone], inside[live, gone] = low, _FAR, False
        right[live, at] = after
        has = after < size[live]
        rank[live, at] = _FAR
        r, i, j = live[has], at[has], after[has]
        left[r, j] = i
        rank[r, i] = pairs(token[r, i], token[r, j])
        before = left[live, at]
        has = before >= 0
        r, i, j = live[has], before[has], at[has]
        rank[r, i] = pairs(token[r, i], token[r, j])
    flat = token[inside].astype("<u4").tobytes()
    stop = (np.cumsum(inside.sum(1)) * 4).tolist()
    return [flat[a:b] for a, b in zip([0, *stop], stop)]


class _Cache:
    """Id bytes of the pre-tokens met so far."""

    def __init__(self, path: str):
        self.ranks, self.known = pretokens.ranks(path), {}
        self.pairs = _Pairs(self.ranks)

    def look_up(self, found: list[bytes]) -> list[bytes]:
        ids = list(map(self.known.get, found))
        open_ = [i for i, x in enumerate(ids) if x is None]
        new = {found[i] for i in open_}
        merged: dict[bytes, bytes] = {}
        by_width: dict[int, list[bytes]] = {}
        for piece in new:
            whole = self.ranks.get(piece)
            if whole is not None:
                merged[piece] = whole.to_bytes(4, "little")
            elif len(piece) > SHORT:
                merged[piece] = np.array(merge(piece, self.ranks), "<u4").tobytes()
            else:
                by_width.setdefault(_WIDTH[len(piece)], []).append(piece)
        for words in by_width.values():
            for i in range(0, len(words), ROWS):
                some = words[i:i + ROWS]
                merged.update(zip(some, merge_all(some, self.ranks, self.pairs)))
        for i in open_:
            ids[i] = merged[found[i]]
        if len(self.known) + len(merged) > CACHE:
            self.known.clear()
        self.known.update((p, x) for p, x in merged.items() if len(p) <= SHORT)
        return ids


@functools.cache
def _cache(path: str) -> _Cache:
    return _Cache(path)


@functools.cache
def _vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes in one array, where each begins, and its length."""
    tokens = sorted((rank, token) for token, rank in pretokens.ranks(path).items())
    size = tokens[-1][0] + 1
    length = np.zeros(size, np.int64)
    length[[r for r, _ in tokens]] = [len(t) for _, t in tokens]
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    return np.frombuffer(b"".join(t for _, t in tokens), np.uint8), begin, length


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Id bytes of each text."""
    table, cache = pretokens.classes(), _cache(path)
    out = []
    for run in pretokens.groups(texts):
        found, which, last = pretokens.distinct(run, table)
        out += pretokens.spread(cache.look_up(found), which, last)
    return out


def token_starts(ids: bytes, path: str) -> bytes:
    """Byte offset in the text of every token."""
    length = _vocabulary(path)[2][np.frombuffer(ids, "<u4")]
    return (np.cumsum(length) - length).astype("<u4").tobytes()


def decode_tokens(ids: bytes, starts: bytes, path: str) -> bytes:
    """The bytes of a run of tokens that lies at ``starts``; the first need not lie at 0."""
    flat, begin, length = _vocabulary(path)
    i, at = np.frombuffer(ids, "<u4"), np.frombuffer(starts, "<u4").astype(np.int64)
    if not len(i):
        return b""
    at = at - at[0]
    if len(at) > 1 and (np.diff(at) != length[i[:-1]]).any():
        raise ValueError("offsets do not belong to these ids")
    size = int(at[-1] + length[i[-1]])
    return flat[np.arange(size) + np.repeat(begin[i] - at, length[i])].tobytes()


ENCODED = "doc_id bigint, n_tokens bigint, ids binary, starts binary"


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for some, texts in parts(batches):
        ids = encode_texts(texts, path)
        yield pa.RecordBatch.from_arrays(
            [some.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
             pa.array([token_starts(x, path) for x in ids], pa.binary())], ["doc_id", "n_tokens", "ids", "starts"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("ids").to_pylist(), batch.column("starts").to_pylist())
        text = [None if a is None or b is None else decode_tokens(a, b, path) for a, b in pairs]
        yield batch.append_column("decoded", pa.array(text, pa.binary()))


def _texts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    return df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, id bytes and token offsets of each whole text.

    A null or empty text has no tokens and empty values. Repeated rows stay and a null id passes
    through; other columns are not carried along, whatever they are called, and an empty table
    gives an empty one.
    """
    ship(df.sparkSession)
    return _texts(df, doc_id, text).mapInArrow(lambda it: _encoded(it, path), ENCODED)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds ``decoded``, the bytes that ids and their offsets stand for; null if either is null."""
    ship(encoded.sparkSession)
    return encoded.select("doc_id", "n_tokens", "ids", "starts").mapInArrow(lambda it: _decoded(it, path), f"{ENCODED}, decoded binary")


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the id bytes and of the bytes decoded from them.

    One worker encodes and decodes, so a task holds one vocabulary.
    """
    ship(df.sparkSession)
    both = _texts(df, "doc_id", "text").mapInArrow(lambda it: _decoded(_encoded(it, path), path), f"{ENCODED}, decoded binary")
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
