"""Hard negatives of anchors, by bounds from summaries of vector segments.

Every vector is stored with the mean and the deviation of its segments, at several fineness levels.
In a segment of w components the product of two vectors lies within w * (mean * mean +- deviation *
deviation), so a pair has bounds from a few numbers. An anchor's candidates are those whose bounds
meet its window of scores. Segments are refined for what is left, and the exact integer products are
made of what is left then.

Anchors and rows meet in a grid of blocks: a row goes to each block of anchors and an anchor to each
block of rows of its group, so a large group becomes many tasks of bounded size. Scores reached in a
sixteenth of the rows raise the lower ends of the windows before the whole table is searched; what
lies below cannot be among the best, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.llm.workers import ship
from paylake.operators.scratch import stored

SCALE = 256  # a component x counts as floor(SCALE * x)
SEGMENTS = (4, 16)  # of a vector, level by level
SQUARE = 2.0**55  # squared length from which products might leave 64 bits
MOST = 50_000  # rows or anchors in a block, about
LEAST = 1_024  # rows for which a block of their own is worth while
SPREAD = 16  # blocks of a group that has enough rows
SAMPLE = 16  # one row in so many is searched first
ANCHORS, ROWS = 256, 4_096  # pairs that a task scores at a time
LOW, HIGH = -(2**62), 2**62
HITS = "anchor bigint, window int, id bigint, row bigint, score bigint"


@dataclass(frozen=True)
class Rule:
    """Which negatives an anchor and a positive have: a share of the positive's score, in percent."""

    positives: int = 5
    negatives: int = 3
    least: int = 50
    most: int = 95


def _edges(d: int, segments: int) -> np.ndarray:
    return (np.arange(segments + 1) * d) // segments


def _levels(d: int) -> list[int]:
    """Numbers of segments of vectors of ``d`` components, coarse to fine."""
    return sorted({min(s, d) for s in SEGMENTS}) if d else []


def summary(x: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments of each level, times the root of the segment's width."""
    out = []
    for s in _levels(x.shape[1]):
        edges = _edges(x.shape[1], s)
        width = np.diff(edges)
        mean = np.add.reduceat(x, edges[:-1], axis=1) / width
        square = np.add.reduceat(x * x, edges[:-1], axis=1) / width
        out += [mean * np.sqrt(width), np.sqrt(np.maximum(square - mean * mean, 0) * width)]
    return np.hstack(out).astype(np.float32) if out else np.zeros((len(x), 0), np.float32)


def prepared(vectors: DataFrame, id_column: str, label: Column, embedding: str) -> DataFrame:
    """row, id, label, vector as packed integers and its summary, of the rows that take part.

    Rows with a null id or label, a null vector, or a null or non-finite component take no part, nor
    does a vector so long that its products might leave 64 bits. Rows that repeat each other count once.
    """
    ship(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("e")
            flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False))
            size = np.fromiter((n or 0 for n in pa.compute.list_value_length(column).to_pylist()), np.int64, len(column))
            begin = np.cumsum(size) - size
            for d in np.unique(size).tolist():
                own = np.flatnonzero(size == d)
                x = flat[begin[own][:, None] + np.arange(d)] if d else np.zeros((len(own), 0))
                fits = (x * x).sum(1) < SQUARE
                own, x = own[fits], x[fits]
                some = batch.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), some.column("label"), pa.array([v.tobytes() for v in x.astype("<i4")], pa.binary()),
                     pa.array([v.tobytes() for v in summary(x).astype("<f4")], pa.binary())], ["id", "label", "vector", "summary"])

    e = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), label.cast("bigint").alias("label"), e.alias("e")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull()
        & F.forall("e", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))))
    packed = rows.mapInArrow(run, "id bigint, label bigint, vector binary, summary binary").distinct()
    return stored(packed.withColumn("row", F.monotonically_increasing_id()), "vectors")  # written, so a row keeps its number


def _unpacked(df: pd.DataFrame, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(df[column]), kind).reshape(len(df), -1) if len(df) else np.zeros((0, 0), kind)


class _Side:
    """Vectors of one length with their summaries."""

    def __init__(self, df: pd.DataFrame, d: int):
        self.id, self.row, self.label = (df[c].to_numpy(np.int64) for c in ("id", "row", "label"))
        self.vector = _unpacked(df, "vector", "<i4").reshape(len(df), d)
        self.summary = _unpacked(df, "summary", "<f4").astype(np.float64).reshape(len(df), -1)
        self.length = np.sqrt((self.vector.astype(np.float64) ** 2).sum(1))


def bounds(a: np.ndarray, b: np.ndarray, d: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Middle and reach of the products of summaries at a level."""
    at = 2 * sum(_levels(d)[:level])
    s = _levels(d)[level]
    return a[:, at:at + s] @ b[:, at:at + s].T, a[:, at + s:at + 2 * s] @ b[:, at + s:at + 2 * s].T


def _left(a: _Side, b: _Side, mine: np.ndarray, here: np.ndarray, low: np.ndarray, high: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors and rows that have a pair whose bounds meet the anchor's scores, level by level."""
    for level in range(len(_levels(d))):
        middle, reach = bounds(a.summary[mine], b.summary[here], d, level)
        reach += 2e-6 * np.outer(a.length[mine], b.length[here]) + 1  # summaries are rounded
        alive = (middle + reach >= low[mine][:, None]) & (middle - reach <= high[mine][:, None])
        mine, here = mine[alive.any(1)], here[alive.any(0)]
        if not len(mine) or not len(here):
            break
    return mine, here


def _products(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Exact integer products; in doubles where these hold all of them."""
    if longest < 2.0**52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _best(a: _Side, b: _Side, lows: np.ndarray, highs: np.ndarray, k: int, same: bool, d: int) -> Iterator[np.ndarray]:
    """Columns of HITS: the first ``k`` rows in each window of each anchor."""
    longest = float(a.length.max(initial=0) * b.length.max(initial=0))
    for begin in range(0, len(a.id), ANCHORS):
        mine = np.arange(begin, min(begin + ANCHORS, len(a.id)))
        found = []
        for first in range(0, len(b.id), ROWS):
            open_ = lows[mine] <= highs[mine]
            low, high = np.full(len(lows), HIGH), np.full(len(lows), LOW)
            low[mine] = np.where(open_, lows[mine], HIGH).min(1)
            high[mine] = np.where(open_, highs[mine], LOW).max(1)
            some, here = _left(a, b, mine[low[mine] <= high[mine]], np.arange(first, min(first + ROWS, len(b.id))), low, high, d)
            if not len(some) or not len(here):
                continue
            score = _products(a.vector[some], b.vector[here], longest)
            other = a.id[some][:, None] != b.id[here]
            other &= (a.label[some][:, None] == b.label[here]) == same
            for w in range(lows.shape[1]):
                fits = other & (score >= lows[some, w][:, None]) & (score <= highs[some, w][:, None])
                if len(here) > k:  # only what reaches the k-th score; later rows have to reach it too
                    reached = np.partition(np.where(fits, score, LOW), -k, axis=1)[:, -k]
                    lows[some, w] = np.maximum(lows[some, w], reached)
                    fits &= score >= reached[:, None]
                i, j = np.nonzero(fits)
                found.append(np.stack([some[i], np.full(len(i), w), b.id[here][j], b.row[here][j], score[i, j]]))
        if found:
            hits = np.hstack(found)
            hits = hits[:, np.lexsort((hits[3], hits[2], -hits[4], hits[1], hits[0]))]
            new = np.concatenate([[True], (np.diff(hits[0]) != 0) | (np.diff(hits[1]) != 0)])[:hits.shape[1]]
            start = np.maximum.accumulate(np.where(new, np.arange(hits.shape[1]), 0))
            hits = hits[:, np.arange(hits.shape[1]) - start < k]
            hits[0] = a.row[hits[0]]
            yield hits


def _met(anchors: pd.DataFrame, rows: pd.DataFrame, k: int, same: bool) -> pd.DataFrame:
    out = [np.zeros((5, 0), np.int64)]
    sizes = anchors["vector"].map(len), rows["vector"].map(len)
    for size in sorted(set(sizes[0]) & set(sizes[1])):
        of, d = anchors[sizes[0] == size], size // 4
        lows, highs = (np.array(of[c].tolist(), np.int64).reshape(len(of), -1) for c in ("lows", "highs"))
        out += _best(_Side(of, d), _Side(rows[sizes[1] == size], d), lows, highs, k, same, d)
    return pd.DataFrame(dict(zip(("anchor", "window", "id", "row", "score"), np.hstack(out))))


def _blocks(n: Column) -> Column:
    return F.greatest(F.ceil(n / MOST), F.least(F.lit(SPREAD), F.ceil(n / LEAST)), F.lit(1))


def search(anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """The first ``k`` rows in each of the anchors' windows: HITS and the rank ``nth``.

    Anchors have ``lows`` and ``highs``, lists of equal length. Rows of the anchor's label are searched
    if ``same``, else those of other labels. Higher scores come first, then smaller ids and row numbers.
    """
    if same:
        sizes = rows.groupBy(F.col("label").alias("of")).agg(F.count("*").alias("n")).join(
            anchors.groupBy(F.col("label").alias("of")).agg(F.count("*").alias("m")), "of")
        sizes = sizes.select("of", _blocks(F.col("n")).alias("n"), F.ceil(F.col("m") / MOST).alias("m"))
    else:  # one group, whose sizes need no join
        n, m = (F.lit(df.count()) for df in (rows, anchors))

    def dealt(df: DataFrame, own: str, other: str, seed: int) -> DataFrame:
        """Each row in its block, once for every block of the other side."""
        if same:
            placed = df.withColumn("of", F.col("label")).join(sizes, "of")
        else:
            placed = df.withColumns({"of": F.lit(0).cast("bigint"), "n": _blocks(n), "m": F.greatest(F.ceil(m / MOST), F.lit(1))})
        place = F.pmod(F.xxhash64("row", F.lit(seed)), F.col(own))
        return placed.select(*df.columns, "of", place.alias(f"_{own}"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(f"_{other}"))

    keys = ("of", "_n", "_m")
    both = dealt(anchors, "m", "n", 1).groupBy(*keys).cogroup(dealt(rows, "n", "m", 2).groupBy(*keys))
    hits = both.applyInPandas(lambda a, b: _met(a, b, k, same), HITS)
    nth = F.row_number().over(Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row"))
    return hits.withColumn("nth", nth).where(F.col("nth") <= k)


def _raised(anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """Anchors whose windows begin at the score that ``k`` of some rows reach already."""
    some = search(anchors, rows.where(F.pmod(F.xxhash64("row", F.lit(3)), F.lit(SAMPLE)) == 0), k, same)
    reached = some.where(F.col("nth") == k).groupBy(F.col("anchor").alias("_of")).agg(
        F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("_reached"))
    lows = F.transform("lows", lambda x, i: F.greatest(x, F.try_element_at("_reached", i)))
    return stored(anchors.join(reached, F.col("row") == F.col("_of"), "left").withColumn("lows", F.when(F.col("_reached").isNull(), F.col("lows")).otherwise(lows)).drop("_of", "_reached"), "anchors")


def first_rows(anchors: DataFrame, rows: DataFrame, k: int, same: bool) -> DataFrame:
    """``search`` in two steps, a part of the rows and then all of them."""
    return stored(search(_raised(anchors, rows, k, same), rows, k, same), "hits")


def mine(rows: DataFrame, anchor: Column, rule: Rule = Rule()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores, from ``prepared`` rows.

    ``anchor`` tells which rows are anchors. Ties go to smaller ids. Vectors of different length have
    no score with each other. Different rows of one id stand for themselves, but none is a candidate
    of its own id. A pair without a negative has no row, and an empty table gives an empty one.
    """
    ends = F.array(F.lit(LOW).cast("bigint")), F.array(F.lit(HIGH).cast("bigint"))
    anchors = stored(rows.where(anchor).withColumns({"lows": ends[0], "highs": ends[1]}), "anchors")
    positives = first_rows(anchors, rows, rule.positives, same=True)

    lows = F.expr(f"({rule.least} * score + pmod(-{rule.least} * score, 100)) div 100")
    highs = F.expr(f"({rule.most} * score - pmod({rule.most} * score, 100)) div 100")
    windows = positives.select("anchor", F.struct((F.col("nth") - 1).alias("w"), lows.alias("low"), highs.alias("high")).alias("x")).groupBy("anchor").agg(
        F.array_sort(F.collect_list("x")).alias("x"))
    windows = windows.select(F.col("anchor").alias("_of"), F.transform("x", lambda x: x["low"]).alias("lows"), F.transform("x", lambda x: x["high"]).alias("highs"))

    def filled(c: str, with_: int) -> Column:
        """Lists of one length, so that those of a block are a matrix; nothing lies in the windows added."""
        return F.concat(c, F.array_repeat(F.lit(with_).cast("bigint"), F.lit(rule.positives) - F.size(c))).alias(c)

    asking = anchors.drop("lows", "highs").join(windows, F.col("row") == F.col("_of")).select(
        "id", "label", "vector", "summary", "row", filled("lows", HIGH), filled("highs", LOW))
    negatives = first_rows(stored(asking, "asking"), rows, rule.negatives, same=False)

    pairs = positives.select(F.col("anchor").alias("_a"), (F.col("nth") - 1).alias("_w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select(F.col("row").alias("_r"), F.col("id").alias("anchor_id"))
    return negatives.join(pairs, (F.col("anchor") == F.col("_a")) & (F.col("window") == F.col("_w"))).join(ids, F.col("anchor") == F.col("_r")).select(
        "anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mined(embeddings: DataFrame) -> DataFrame:
    """Negatives of the anchors of a table whose every seventh label is moved on by one, as noise."""
    label = F.col("label").cast("bigint")
    moved = F.when(F.pmod(F.col("vec_id"), F.lit(7)) == 0, (label + 1) % 10).otherwise(label)
    rows = prepared(embeddings, "vec_id", moved, "embedding")
    return mine(rows, F.pmod(F.col("id"), F.lit(50)) == 0)
