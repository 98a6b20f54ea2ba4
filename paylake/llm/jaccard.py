"""Near duplicates by the Jaccard similarity of word n-gram sets: a distributed prefix-tree join.

All n-grams have one global order, that of their 64-bit hashes, and every document is its ordered
set. The order line is cut into stretches, and what a set has in a stretch is a path of that
stretch's tree, known by a digest. Two similar sets differ in a bounded number of elements, so a
known number of their paths at least are equal, about half of them; documents meet where whole paths
are, for sets of about one size.

A path that more than a few documents have is common, as those of a passage that many documents
share. The others are counted for each pair of documents: a pair that cannot reach the number it
must share, even if all its common paths were equal, is dropped. So a passage that two texts share
does not bring them together. Documents that have so many common paths that they may share no other
meet on these, on the first ones of their order that some similar document must share too.

Documents that meet form clusters. Copies of one set are one member. The sets of a cluster go into a
prefix tree (:mod:`paylake.llm.prefix_tree`), which finds the exact links; a cluster with many
members is dealt out as pairs of blocks. Components of the links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window, functions as F

from paylake.llm.components import components
from paylake.llm.prefix_tree import PrefixTree
from paylake.llm.shingles import mixed, shingle_sets
from paylake.llm.workers import ship
from paylake.operators.scratch import stored

BLOCK = 1_000  # members of a cluster that a block holds
ELEMENTS = 500_000  # n-grams of all of them, about
COMMON = 3  # documents that may share a path which is not common
_CODES = 1 << 20


@dataclass(frozen=True)
class Similarity:
    """Words of an n-gram and the least Jaccard similarity in percent."""

    words: int = 5
    percent: int = 80

    def spaces(self, n: int) -> range:
        """The size classes in which a set of n elements may meet another."""
        return range(_space(-(-self.percent * n // 100)), _space(n) + 1)

    def stretches(self, space: int) -> tuple[int, int]:
        """How many stretches the order line has in a class, and how many may differ."""
        most = _bound(space + 1) - 1
        differ = (100 - self.percent) * (most + 100 * most // self.percent) // (100 + self.percent)
        return differ + 1 + (max(2, differ) if differ else 0), differ


def _bound(space: int) -> int:
    """Least size of a class: 1, 2, 3, 4, 6, 9 and so on, about 1.6 times the one before."""
    size = 1
    for _ in range(space):
        size = max(size + 1, size * 8 // 5)
    return size


_BOUNDS = [_bound(s) for s in range(100)]


def _space(n: int) -> int:
    return int(np.searchsorted(_BOUNDS, n, "right")) - 1


def paths(elements: np.ndarray, like: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the paths of a set in all stretches and classes where it may meet another.

    With each goes a code of its class and of the number of common paths from which on the set has
    to meet others on common paths too.
    """
    spread, found, codes = mixed(elements + np.uint64(0x632BE59BD9B4E019)), [], []
    for space in like.spaces(len(elements)):
        count, differ = like.stretches(space)
        part = (elements >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
        begin = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        sums, own = np.add.reduceat(spread, begin), part[begin]
        spare = count - differ - (count - len(begin))  # equal stretches that are neither empty
        if spare <= 0:  # they may all be empty ones
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), own)
            sums, own = np.concatenate([sums, np.zeros(len(empty), np.uint64)]), np.concatenate([own, empty])
        found.append(mixed(sums ^ mixed(own * np.uint64(1 << 16) + np.uint64(space + 1))))
        codes.append(np.full(len(own), space * _CODES + min(max(0, spare), _CODES - 1)))
    return np.concatenate(found), np.concatenate(codes)


def _digest(elements: np.ndarray) -> np.uint64:
    return np.add.reduce(mixed(elements ^ np.uint64(0xA0761D6478BD642F))) if len(elements) else np.uint64(0)


#: Rows on the way: of documents (b a digest, n the size), of links (b the other document), of
#: common paths (b the path, n minus the code, less one), of other paths (n the code), and marks of
#: paths that are common already (a missing).
MET = "key bigint, a bigint, b bigint, n bigint"
#: The same of documents, links and common paths; a pair (a, b) with the codes n and m shares k rare paths.
FOUND = "a bigint, b bigint, n bigint, m bigint, k bigint"


def _rows(key, a=None, b=None, n=None) -> pa.RecordBatch:
    size = len(key)
    columns = [np.asarray(key).view(np.int64), a, b, n]
    return pa.RecordBatch.from_arrays(
        [pa.nulls(size, pa.int64()) if c is None else pa.array(np.asarray(c).astype(np.int64)) for c in columns], ["key", "a", "b", "n"])


def _spread(doc: np.ndarray) -> np.ndarray:
    return mixed(doc.astype(np.int64).view(np.uint64) + np.uint64(7))


def _meetings(like: Similarity):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            known = np.array(ids.is_valid())
            doc = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keys, owners, codes, sizes, digests, first, copies = [], [], [], [], [], {}, []
            texts = (t or "" for t in batch.column("text").to_pylist())
            for i, elements in enumerate(shingle_sets(list(texts), like.words)):
                sizes.append(len(elements))
                digests.append(_digest(elements))
                if len(elements) and known[i]:
                    same = first.setdefault((digests[-1], len(elements)), doc[i])
                    if same != doc[i]:
                        copies.append((doc[i], same))
                        continue
                    key, code = paths(elements, like)
                    keys.append(key)
                    codes.append(code)
                    owners.append(np.full(len(key), doc[i]))
            size, digest = np.array(sizes, np.int64), np.array(digests, np.uint64).view(np.int64)
            if known.any():
                yield _rows(_spread(doc[known]), doc[known], digest[known], size[known])
            if not known.all():
                yield _rows(_spread(np.flatnonzero(~known)), None, digest[~known], size[~known])
            if copies:
                a, b = np.array(copies, np.int64).T
                yield _rows(_spread(a), a, b)
            if keys:
                key, owner, code = np.concatenate(keys), np.concatenate(owners), np.concatenate(codes)
                order = np.lexsort((owner, key))
                key, owner, code = key[order], owner[order], code[order]
                often, begin = _run_lengths(key)
                hot = often > COMMON
                if hot.any():
                    yield _rows(_spread(owner[hot]), owner[hot], key[hot].view(np.int64), -code[hot] - 1)
                    yield _rows(key[begin][often[begin] > COMMON])
                yield _rows(key[~hot], owner[~hot], None, code[~hot])

    return run


def _run_lengths(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the sorted rows, how many have its key; where runs begin."""
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    length = np.diff(np.append(begin, len(key)))
    return np.repeat(length, length), begin


def _shared(key: np.ndarray, doc: np.ndarray, code: np.ndarray) -> list[np.ndarray]:
    """Pairs of documents within runs of equal keys of at most COMMON rows: both, their codes, and how often."""
    found = []
    for far in range(1, COMMON):
        at = np.flatnonzero((key[far:] == key[:-far]) & (doc[far:] != doc[:-far]))
        found.append(np.stack([doc[at], doc[at + far], code[at], code[at + far]]))
    pairs = np.hstack(found)
    turned = pairs[0] > pairs[1]
    pairs[:, turned] = pairs[:, turned][[1, 0, 3, 2]]
    pairs = pairs[:, np.lexsort(pairs)]
    new = np.flatnonzero(np.concatenate([[True], (pairs[:, 1:] != pairs[:, :-1]).any(0)])[:pairs.shape[1]])
    return [*pairs[:, new], np.diff(new, append=pairs.shape[1])]


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of paths in sorted order, the documents of rare ones become pairs, the others' are kept."""
    held, hot_key = np.zeros((4, 0), np.int64), None

    def told(rows: np.ndarray, common: np.ndarray) -> pa.RecordBatch:
        key, doc, code, mark = rows
        some = ~common & (mark == 0)
        pairs = _shared(key[some], doc[some], code[some])
        hot = common & (mark == 0)
        none = pa.nulls(int(hot.sum()), pa.int64())
        columns = [np.concatenate(c) for c in zip(pairs[:3], (doc[hot], key[hot], -code[hot] - 1))]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), *[pa.concat_arrays([pa.array(c.astype(np.int64)), none]) for c in pairs[3:]]], ["a", "b", "n", "m", "k"])

    for batch in batches:
        passing = batch.column("b").is_valid()
        through = batch.filter(passing)
        if len(through):
            none = pa.nulls(len(through), pa.int64())
            yield pa.RecordBatch.from_arrays([*through.select(["a", "b", "n"]).columns, none, none], ["a", "b", "n", "m", "k"])
        path = batch.filter(pa.compute.invert(passing))
        if not len(path):
            continue
        doc = path.column("a")
        rows = np.stack([
            path.column("key").to_numpy(), doc.fill_null(0).to_numpy(), path.column("n").fill_null(0).to_numpy(), np.array(doc.is_null()).astype(np.int64)])
        rows = np.concatenate([held, rows], 1)
        often, begin = _run_lengths(rows[0])
        marked = np.repeat(np.maximum.reduceat(rows[3], begin), often[begin]) > 0
        common = (often > COMMON) | marked | (rows[0] == hot_key if hot_key is not None else False)
        last = begin[-1]
        if common[last]:  # more rows of this path may follow
            hot_key, held = rows[0, last], np.zeros((4, 0), np.int64)
            yield told(rows, common)
        else:
            held = rows[:, last:]
            yield told(rows[:, :last], common[:last])
    yield told(held, np.zeros(held.shape[1], bool))


def _rarest_first(sets: list[np.ndarray]) -> list[np.ndarray]:
    """The sets as ascending numbers of their elements, those that fewer of the sets have first."""
    if not sets:
        return []
    known, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.empty(len(known), np.int64)
    number[np.lexsort((known, n))] = np.arange(len(known))
    return [np.sort(part) for part in np.split(number[which], np.cumsum(list(map(len, sets)))[:-1])]


def _joined(like: Similarity):
    """Exact links within each task's members; rows come sorted by task."""

    def links(docs: list[int], texts: list[str]) -> Iterator[tuple[int, int]]:
        tree, ids = PrefixTree(like.percent), []
        for doc, elements in zip(docs, _rarest_first(list(shingle_sets(texts, like.words)))):
            if len(elements):
                ids.append(doc)
                for other in tree.add(elements):
                    if ids[other] != doc:
                        yield doc, ids[other]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, docs, texts, found = None, [], [], []
        for batch in batches:
            for t, d, x in zip(*(batch.column(c).to_pylist() for c in ("task", "doc_id", "text"))):
                if t != task:
                    found += links(docs, texts)
                    task, docs, texts = t, [], []
                docs.append(d)
                texts.append(x)
            yield _pairs(found)
            found = []
        yield _pairs(list(links(docs, texts)))

    return run


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])


def _on_rare_paths(pairs: DataFrame, common: DataFrame) -> DataFrame:
    """Pairs that share as many paths as similar ones must, or would if their common ones were equal."""
    counted = pairs.groupBy("a", "b", "n", "m").agg(F.sum("k").alias("k")).withColumn(
        "need", F.greatest(F.pmod("n", F.lit(_CODES)), F.pmod("m", F.lit(_CODES))))
    counted = stored(counted, "pairs")
    often = common.groupBy(F.col("a").alias("doc"), (-F.col("n") - 1).alias("code")).agg(F.count("*").alias("often"))
    often = stored(often, "often")

    def of(doc: str, code: str) -> DataFrame:
        return often.select(F.col("doc").alias(doc), F.col("code").alias(code), F.col("often").alias(f"often_{doc}"))

    open_ = counted.where("k < need").join(of("a", "n"), ["a", "n"]).join(of("b", "m"), ["b", "m"])
    return counted.where("k >= need").select("a", "b").union(open_.where("k + least(often_a, often_b) >= need").select("a", "b")).distinct()


def _on_common_paths(rows: DataFrame) -> DataFrame:
    """Links between documents that have so many common paths that they may share no other.

    Of ``often`` common paths two such documents share ``spare`` at least, so the first of these, in any
    order, is among the first often - spare + 1 of both; the others need not be met on.
    """
    own = Window.partitionBy("a", "n")  # a document's common paths of one class
    spare = F.pmod(-F.col("n") - 1, F.lit(_CODES))
    ranked = rows.withColumns({"often": F.count("*").over(own), "nth": F.row_number().over(own.orderBy("b"))})
    heavy = ranked.where((F.col("often") >= spare) & (F.col("nth") <= F.col("often") - F.greatest(spare, F.lit(1)) + 1)).select("a", F.col("b").alias("path"))
    heavy = stored(heavy, "common")
    first = heavy.groupBy(F.col("path").alias("p")).agg(F.min("a").alias("first"))
    return heavy.join(first, F.col("path") == F.col("p")).where("a <> first").select("a", "first").distinct()


def near_duplicates(documents: DataFrame, like: Similarity = Similarity()) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every row.

    A null or empty text, or one of blanks alone, has no n-grams and links with nothing; a text
    with fewer words than an n-gram is one n-gram. Rows of equal doc_id are one document, with the
    links of each row; a null doc_id links with nothing and has itself, null, as component. Other
    columns are not carried along, and an empty table gives an empty one.
    """
    ship(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.mapInArrow(_meetings(like), MET).repartition("key").sortWithinPartitions("key", "a")
    met = stored(rows.mapInArrow(_met, FOUND), "meetings")
    alone = met.where("m is null")
    docs = alone.where("n >= 0").select(F.col("a").alias("doc_id"), F.col("b").alias("digest"), F.col("n").alias("n_shingles"))
    common = alone.where("n < 0").select("a", "b", "n")
    meetings = _on_rare_paths(met.where("m is not null"), common).union(_on_common_paths(common))
    clusters = components(alone.where("n is null").select("a", "b").union(meetings))
    clusters = stored(clusters.union(clusters.select("component", "component")).distinct(), "clusters")
    placed = docs.where("n_shingles > 0").join(clusters, F.col("doc_id") == F.col("node")).select("doc_id", "digest", "n_shingles", "component")
    same = ["component", "n_shingles", "digest"]
    first = placed.groupBy(*same).agg(F.min("doc_id").alias("first"))
    copies = stored(placed.join(first, same).select("doc_id", "first", "component", "n_shingles"), "copies")
    members = copies.where("doc_id = first").select("doc_id", "component", "n_shingles").distinct()
    sizes = members.groupBy("component").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("elements")).where("members > 1")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("elements") / ELEMENTS)).cast("bigint")
    mine = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    dealt = (
        members.join(sizes.withColumn("blocks", blocks), "component").withColumn("mine", mine)
        .withColumn("other", F.explode(F.expr("case when blocks = 1 then array(0L) else filter(sequence(0L, blocks - 1), x -> x <> mine) end")))
        .select(F.col("doc_id").alias("member"), F.xxhash64("component", F.least("mine", "other"), F.greatest("mine", "other")).alias("task")))
    members_text = texts.join(dealt.hint("merge"), F.col("doc_id") == F.col("member")).select("task", "doc_id", "text")
    tasks = members_text.repartition("task").sortWithinPartitions("task", "doc_id")
    links = tasks.mapInArrow(_joined(like), "a bigint, b bigint").union(copies.where("doc_id <> first").select("doc_id", "first"))
    reached = components(links)
    return docs.join(reached, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
