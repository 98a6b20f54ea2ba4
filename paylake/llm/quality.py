"""Quality by co-training two views of a document.

One classifier sees the text's content, the other the page: language, source, declared length and
layout. Both start from the same labelled documents. In every round each view labels the unlabelled
documents it is surest of, a growing share of all of them, and the other learns from those labels too.
On labelled documents kept apart, each view's log-odds are calibrated and the two are combined; the
result scores every document. Features are cut at quantiles, so a linear classifier can follow any
shape of each.

Labelled documents are a bounded sample on the driver. The unlabelled ones, all of them, stay in a
table of small codes: a round counts how sure the views are of them, and each step of learning sums
the slopes of the pseudo-labelled ones, so a few hundred sums reach the driver.
"""

from __future__ import annotations

import functools
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paylake.llm import letters, linear
from paylake.llm.batches import release, stretches, texts_of
from paylake.llm.pretokens import groups
from paylake.llm.sampling import lowest
from paylake.llm.workers import ship
from paylake.operators.scratch import stored

LABELLED = 8_000  # labelled documents that are learned from and calibrated on
ROUNDS = 3
STEPS = 4  # of learning in a round
SURE = 2.2  # log-odds from which a view is sure of a label: nine tenths
SHARE = 0.1  # of the unlabelled documents that each further round may label, the surest first
TRUST = 0.5  # weight of all pseudo-labels, to that of the labels, at most
STEP, STEPS_WIDE = 0.05, 800  # log-odds are counted in steps
RIDGE = 2.0
BINS = 10  # quantiles of a feature
LANGS, SOURCES = 8, 32  # columns that languages and sources are hashed to
COLUMNS = ("text", "lang", "source", "n_chars")

CONTENT = ("letters", "upper", "digits", "points", "symbols", "word length", "distinct words", "repeated words", "symbol ends", "blanks")
LAYOUT = ("declared length", "length", "lines", "line length", "distinct lines", "bars", "wide characters")
UPPER, LOWER, DIGIT, POINT, SYMBOL, BLANK, LINE, BAR = range(8)


@functools.cache
def _kinds() -> np.ndarray:
    kind = np.full(0x110000, SYMBOL, np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))
        if c[0] == "L" or c[0] == "M":
            kind[cp] = UPPER if c == "Lu" else LOWER
        elif c[0] == "N":
            kind[cp] = DIGIT
        elif c[0] == "Z":
            kind[cp] = BLANK
    kind[[ord(c) for c in ".,;:'\"()-"]] = POINT
    kind[[9, 11, 12]], kind[[10, 13]], kind[ord("|")] = BLANK, LINE, BAR
    return kind


def _distinct(key: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many different keys each owner has."""
    if not len(key):
        return np.zeros(n)
    order = np.lexsort((key, owner))
    k, o = key[order], owner[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])])
    return np.bincount(o[new], minlength=n).astype(float)


def features(texts: list[str], declared: np.ndarray) -> np.ndarray:
    """Content and layout features of each text, in the order of CONTENT and LAYOUT."""
    out, done = [], 0
    for run, w in zip(groups(texts, letters.GROUP), letters.words(texts)):
        n = len(run)
        size = np.fromiter(map(len, run), np.int64, n)
        cps = np.frombuffer(("\n".join(run) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _kinds()[cps]
        doc = np.repeat(np.arange(n), size + 1)
        count = np.bincount(doc * 8 + kind, minlength=n * 8).reshape(n, 8).astype(float)
        count[:, LINE] -= 1  # the one between the texts
        letter = count[:, UPPER] + count[:, LOWER]
        chars = np.maximum(size, 1)
        ends = (kind[:-1] == SYMBOL) & ((kind[1:] == BLANK) | (kind[1:] == LINE))
        symbol_ends = np.bincount(doc[:-1][ends], minlength=n)
        owner = w.owner()
        words = np.maximum(np.diff(w.ends, prepend=0), 1)
        h = w.hashes(w.begin, w.stop)
        again = np.concatenate([[False], (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])]) if len(h) else np.zeros(0, bool)
        line_end = np.flatnonzero(kind == LINE)
        line = letters.between(letters.running(cps), np.concatenate([[0], line_end[:-1] + 1]), line_end)
        lines = count[:, LINE] + 1
        out.append(np.stack([
            letter / chars, count[:, UPPER] / np.maximum(letter, 1), count[:, DIGIT] / chars, count[:, POINT] / chars, count[:, SYMBOL] / chars,
            letter / words, _distinct(h, owner, n) / words, np.bincount(owner[again], minlength=n) / words, symbol_ends / words, count[:, BLANK] / chars,
            np.log1p(np.maximum(declared[done:done + n], -1) + 1), np.log1p(size), np.log1p(lines), np.log1p(size / lines),
            _distinct(line, doc[line_end], n) / lines, count[:, BAR] / chars,
            np.bincount(doc, cps > 0x7F, minlength=n) / chars], 1))
        done += n
    return np.concatenate(out) if out else np.zeros((0, len(CONTENT) + len(LAYOUT)))


@dataclass
class Coding:
    """Documents as codes: the column, of a view's one-hot matrix, that each feature falls in."""

    edges: list[np.ndarray]

    def widths(self) -> tuple[list[int], list[int]]:
        sizes, k = [len(e) + 1 for e in self.edges], len(CONTENT)
        return sizes[:k], [*sizes[k:], LANGS, SOURCES]

    def codes(self, x: np.ndarray, langs: list, sources: list) -> list[np.ndarray]:
        """Of the content and of the page: (documents, features)."""
        bins = [np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)]
        hashed = [np.array([zlib.crc32((v or "").encode()) % n for v in values], np.int64) for values, n in ((langs, LANGS), (sources, SOURCES))]
        k, out = len(CONTENT), []
        for columns, sizes in zip((bins[:k], [*bins[k:], *hashed]), self.widths()):
            begin = np.cumsum(sizes) - sizes
            out.append(np.stack([c + b for c, b in zip(columns, begin)], 1).astype(np.int32))
        return out

    def one_hot(self, codes: np.ndarray, view: int) -> np.ndarray:
        out = np.zeros((len(codes), sum(self.widths()[view])))
        out[np.arange(len(codes))[:, None], codes] = 1
        return out


def odds(codes: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Log-odds of codes by weights, the bias last."""
    return w[codes].sum(1) + w[-1]


@dataclass
class Model:
    coding: Coding
    weights: list[np.ndarray]
    calibration: list[np.ndarray]
    combination: np.ndarray

    def scores(self, x: np.ndarray, langs: list, sources: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good quality: combined, of the content and of the page."""
        each = [linear.apply(odds(c, w)[:, None], k) for c, w, k in zip(self.coding.codes(x, langs, sources), self.weights, self.calibration)]
        return linear.sigmoid(linear.apply(np.stack(each, 1), self.combination)), linear.sigmoid(each[0]), linear.sigmoid(each[1])


def _edges(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Quantiles of each feature in both classes."""
    steps = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.concatenate([np.quantile(c[y == v], steps) for v in (0, 1)] + [np.quantile(c, [0.005, 0.995])])) for c in x.T]


#: A function that gives vectors by view for a part of the documents, and one that sums them over all,
#: from the function and the vectors' lengths.
Sums = Callable[[list[np.ndarray]], list[np.ndarray]]
Gather = Callable[[Sums, list[int]], list[np.ndarray]]


def _how_sure(weights: list[np.ndarray]) -> Sums:
    """How many documents each view is how sure of, in steps of STEP."""
    def count(codes: list[np.ndarray]) -> list[np.ndarray]:
        return [np.bincount(np.minimum(np.abs(odds(c, w)) / STEP, STEPS_WIDE - 1).astype(np.int64), minlength=STEPS_WIDE).astype(float)
                for c, w in zip(codes, weights)]

    return count


def _slopes(weights: list[np.ndarray], teachers: list[np.ndarray], least: list[float]) -> Sums:
    """Slope of each view's loss on the documents that the other, as it was, is sure of."""
    def add(codes: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for v, w in enumerate(weights):
            said = odds(codes[1 - v], teachers[1 - v])
            sure = np.abs(said) >= least[1 - v]
            mine = codes[v][sure]
            off = linear.sigmoid(odds(mine, w)) - (said[sure] > 0)
            slope = np.bincount(mine.ravel(), np.repeat(off, mine.shape[1]), len(w))[: len(w)]
            slope[-1] = off.sum()
            out.append(slope)
        return out

    return add


def _least_sure(counts: np.ndarray, share: float) -> tuple[float, float]:
    """Log-odds that at most a share of the documents reach, SURE at least, and how many reach it."""
    reach = np.cumsum(counts[::-1])[::-1]
    first = max(int(np.ceil(SURE / STEP)), int(np.argmax(reach <= share * counts.sum())) if (reach <= share * counts.sum()).any() else STEPS_WIDE)
    return (first * STEP, float(reach[first])) if first < STEPS_WIDE else (np.inf, 0.0)


def teach(coding: Coding, codes: list[np.ndarray], y: np.ndarray, gather: Gather) -> list[np.ndarray]:
    """Weights of both views from labelled documents and, round by round, from each other."""
    x = [np.hstack([coding.one_hot(c, v), np.ones((len(c), 1))]) for v, c in enumerate(codes)]
    weights = [linear.fit(v[:, :-1], y, ridge=RIDGE) for v in x]
    for r in range(ROUNDS):
        counts = gather(_how_sure(weights), [STEPS_WIDE] * 2)
        least, taught = zip(*[_least_sure(c, SHARE * (r + 1)) for c in counts])
        if not any(taught):
            break
        teachers = [w.copy() for w in weights]
        for _ in range(STEPS):
            slopes = gather(_slopes(weights, teachers, list(least)), list(map(len, weights)))
            for v, w in enumerate(weights):
                trust = min(1.0, TRUST * len(y) / max(taught[1 - v], 1.0))
                penalty = np.full(len(w), RIDGE)
                penalty[-1] = 1e-6
                p = linear.sigmoid(x[v] @ w)
                slope = x[v].T @ (p - y) + trust * slopes[v] + penalty * w
                # The labelled documents' curvature stands for that of all; it is the larger one.
                more = 1 + trust * taught[1 - v] / len(y)
                bend = more * (x[v] * np.maximum(p * (1 - p), 1e-3)[:, None]).T @ x[v] + np.diag(penalty)
                step = np.linalg.solve(bend, slope)
                weights[v] = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return weights


def split(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the labelled documents that are learned from and of those that are kept apart, a quarter."""
    places = np.arange(len(y))
    held, train = places[places % 4 == 3], places[places % 4 != 3]
    if not len(held) or len(np.unique(y[held])) < 2 or len(np.unique(y[train])) < 2:
        return places, places
    return train, held


def finished(coding: Coding, weights: list[np.ndarray], codes: list[np.ndarray], y: np.ndarray) -> Model:
    """Calibrates and combines the views on labelled documents kept apart."""
    each = [odds(c, w)[:, None] for c, w in zip(codes, weights)]
    calibration = [linear.fit(o, y) for o in each]
    both = np.hstack([linear.apply(o, c)[:, None] for o, c in zip(each, calibration)])
    return Model(coding, weights, calibration, linear.fit(both, y))


def _read(columns: tuple[pa.Array, ...]) -> tuple[np.ndarray, list, list]:
    text, lang, source, n_chars = columns
    declared = n_chars.cast(pa.float64()).fill_null(-1).to_numpy(zero_copy_only=False)
    found = [features(texts_of(text[a:b]), declared[a:b]) for a, b in stretches(text)]
    return np.concatenate([np.zeros((0, len(CONTENT) + len(LAYOUT))), *found]), lang.to_pylist(), source.to_pylist()


def _columns(df: DataFrame) -> list[Column]:
    """The columns that are read, null where a table has none."""
    kinds = {"n_chars": "bigint"}
    return [F.col(c).cast(kinds.get(c, "string")) if c in df.columns else F.lit(None).cast(kinds.get(c, "string")) for c in COLUMNS]


def _gatherer(coded: DataFrame) -> Gather:
    """Sums over all rows of a table of codes; only the sums come to the driver."""
    def gather(of: Sums, sizes: list[int]) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                found = of([np.stack(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("content", "page")])
                total = found if total is None else [a + b for a, b in zip(total, found)]
            for view, sums in enumerate(total or []):
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), view)), pa.array(at), pa.array(sums[at].astype(np.float64))], ["view", "at", "sum"])

        rows = coded.select("content", "page").mapInArrow(run, "view bigint, at bigint, sum double").groupBy("view", "at").agg(F.sum("sum").alias("sum"))
        out = [np.zeros(n) for n in sizes]
        for view, own in rows.toPandas().groupby("view"):
            out[view][own["at"]] = own["sum"]
        return out

    return gather


def _codes(documents: DataFrame, coding: Coding) -> DataFrame:
    """id and the codes of both views, of every document."""
    @F.arrow_udf("struct<content: array<int>, page: array<int>>")
    def udf(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            found = coding.codes(*_read(columns))
            arrays = [pa.FixedSizeListArray.from_arrays(pa.array(c.ravel()), c.shape[1]).cast(pa.list_(pa.int32())) for c in found]
            yield pa.StructArray.from_arrays(arrays, ["content", "page"])
        release()

    return documents.select(F.col("doc_id").cast("bigint").alias("id"), udf(*_columns(documents)).alias("c")).select("id", "c.*")


def learn(documents: DataFrame, labels: DataFrame) -> Model | None:
    """Co-trains on labels (doc_id, quality 0 or 1); None where a class has no documents.

    At most LABELLED labelled documents count, those whose ids have the lowest hash, and all that have
    no label. Null ids and other labels are left out; of several labels of an id the largest holds.
    """
    ship(documents.sparkSession)
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(F.max("quality").cast("int").alias("y"))
    ids = stored(documents.select(F.col("doc_id").cast("bigint").alias("id")).join(known, "id").distinct().withColumn("all", F.lit(1)), "labelled")
    chosen = stored(ids.where(lowest(ids, "id", "all", LABELLED)).select("id", "y"), "chosen")

    @F.arrow_udf("array<double>")
    def udf(text: pa.Array, n_chars: pa.Array) -> pa.Array:
        nothing = pa.nulls(len(text), pa.string())
        return pa.array(list(_read((text, nothing, nothing, n_chars))[0]), pa.list_(pa.float64()))

    text, lang, source, n_chars = _columns(documents)
    sample = documents.join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    rows = sample.select("id", "y", lang.alias("lang"), source.alias("source"), udf(text, n_chars).alias("x")).toPandas()
    rows["order"] = [zlib.crc32(str(i).encode()) for i in rows["id"]]
    rows = rows.sort_values(["order", "id", "source"], kind="stable")
    y = rows["y"].to_numpy().astype(float)
    if not {0, 1} <= set(y.tolist()):
        return None
    x, langs, sources = np.stack(rows["x"].to_list()), rows["lang"].tolist(), rows["source"].tolist()
    train, held = split(y)
    coding = Coding(_edges(x[train], y[train]))
    codes = coding.codes(x, langs, sources)
    coded = stored(_codes(documents, coding), "codes")  # a few dozen small numbers a document
    open_ = stored(coded.join(ids.select("id"), "id", "left_anti"), "open")
    weights = teach(coding, [c[train] for c in codes], y[train], _gatherer(open_))
    return finished(coding, weights, [c[held] for c in codes], y[held])


def score(documents: DataFrame, model: Model | None, into: str = "quality") -> DataFrame:
    """Adds ``into``: probability of good quality, combined and by either view, of every whole text.

    A null text is empty; null languages, sources and lengths are values of their own. Without a
    model all documents count as good. A column already called ``into`` is replaced, other columns
    and repeated rows stay, and an empty table gives an empty one.
    """
    ship(documents.sparkSession)

    @F.arrow_udf("struct<combined: double, content: double, page: double>")
    def udf(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            x, langs, sources = _read(columns)
            found = model.scores(x, langs, sources) if model else [np.ones(len(x))] * 3
            yield pa.StructArray.from_arrays([pa.array(c) for c in found], ["combined", "content", "page"])
        release()

    return documents.withColumn(into, udf(*_columns(documents)))


def held_out_quality(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from four fifths of the labels and scores all documents."""
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    q = F.col("quality")
    return score(documents.select("doc_id", *COLUMNS), learn(documents, labels.where(~fold))).select(
        "doc_id", fold.alias("held_out"), q.combined.alias("score"), q.content.alias("content_score"), q.page.alias("page_score"),
        (q.combined >= 0.5).cast("int").alias("predicted"))
