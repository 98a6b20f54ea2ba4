"""Language identification by unigrams of word pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary, and every single letter. A language is a
probability for each piece. The probability of a word is the sum over all its segmentations, by a
forward pass over its letters; a text is the product over its words. Piece probabilities come from
expectation maximisation: forward and backward passes over the counted words of a bounded number of
labelled documents for each language.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.llm import letters
from paylake.llm.batches import parts
from paylake.llm.sampling import lowest
from paylake.llm.workers import ship
from paylake.operators.scratch import stored

SAMPLE = 2_000  # labelled documents of each language that the probabilities are learned from
ROUNDS = 3
LONGEST = 48  # letters of a word; a longer run of letters is taken in parts
PIECE = LONGEST  # letters that a piece may have: any that fits in a word
LEAST = 1e-7  # probability of a letter or piece that a language was never seen with
LIFT = 2.0**11  # factor for each letter, near LEAST ** -0.5: LONGEST letters stay far from 0 and from infinity
UNKNOWN = "und"


@functools.cache
def vocabulary(path: str) -> tuple[np.ndarray, int]:
    """Sorted hashes of the vocabulary's pieces of letters, in lower case, without the word mark; letters of the longest."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).replace("▁", "").lower() for i in range(model.get_piece_size())}
    pieces = sorted(p for p in pieces if p.isalpha() and 1 < len(p) <= PIECE)
    found = []
    for w in letters.words(pieces):
        found.append(w.hashes(np.concatenate([[0], w.stops[:-1] + 1]), w.stops))
    return np.unique(np.concatenate(found)), max(map(len, pieces))


class _Table:
    """Piece numbers by hash; single letters have numbers of their own after the pieces."""

    SINGLES = 4096  # single letters share numbers by hash

    def __init__(self, path: str):
        self.hashes, self.longest = vocabulary(path)
        self.size = len(self.hashes) + self.SINGLES + 1
        bits = 18
        self.shift = np.uint64(64 - bits)
        self.slot = np.searchsorted(self.hashes >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64))

    def numbers(self, h: np.ndarray, single: bool) -> np.ndarray:
        """The last number means: no piece."""
        if single:
            return len(self.hashes) + (letters.mixed(h) % np.uint64(self.SINGLES)).astype(np.int64)
        at = np.searchsorted(self.hashes, h)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == h, at, self.size - 1)


@functools.cache
def _table(path: str) -> _Table:
    return _Table(path)


def _pieces(w: letters.Words, begin: np.ndarray, stop: np.ndarray, table: _Table) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Number of live words, position, length and piece numbers, for words sorted by falling length."""
    size = stop - begin
    for at in range(1, int(size[0]) + 1 if len(size) else 0):
        live = int(np.searchsorted(-size, -at, "right"))
        for n in range(1, min(table.longest, at) + 1):
            a = begin[:live] + at - n
            yield live, at, n, table.numbers(w.hashes(a, a + n), n == 1)


def word_scores(w: letters.Words, begin: np.ndarray, stop: np.ndarray, table: _Table, p: np.ndarray) -> np.ndarray:
    """Log-probability of each word in every language: (words, languages).

    Every segmentation of a word has the same letters, so a factor for each letter is one factor of
    the word, which is taken out again at the end.
    """
    size = stop - begin
    order = np.argsort(-size, kind="stable")
    b, s = begin[order], stop[order]
    forward = np.zeros((len(b), int(size.max()) + 1 if len(b) else 1, p.shape[1]))
    forward[:, 0] = 1
    for live, at, n, piece in _pieces(w, b, s, table):
        if n == 1:
            forward[:live, at] += forward[:live, at - 1] * (p[piece] * LIFT)
        else:
            some = np.flatnonzero(piece != table.size - 1)
            forward[some, at] += forward[some, at - n] * (p[piece[some]] * LIFT**n)
    out = np.empty((len(b), p.shape[1]))
    out[order] = np.log(forward[np.arange(len(b)), (s - b)]) - ((s - b) * np.log(LIFT))[:, None]
    return out


def _expected(w: letters.Words, begin: np.ndarray, stop: np.ndarray, count: np.ndarray, table: _Table, p: np.ndarray) -> np.ndarray:
    """Expected uses of every piece in words that occur ``count`` times, for one language."""
    order = np.argsort(-(stop - begin), kind="stable")
    b, s, count = begin[order], stop[order], count[order]
    size = s - b
    steps = list(_pieces(w, b, s, table))
    forward = np.zeros((len(b), int(size.max()) + 1))
    forward[:, 0] = 1
    for live, at, n, piece in steps:
        forward[:live, at] += forward[:live, at - n] * (p[piece] * LIFT**n)
    backward = np.zeros_like(forward)
    backward[np.arange(len(b)), size] = 1
    uses = np.zeros(table.size)
    share = count / forward[np.arange(len(b)), size]
    for live, at, n, piece in reversed(steps):
        value = p[piece] * LIFT**n * backward[:live, at]
        uses += np.bincount(piece, forward[:live, at - n] * value * share[:live], table.size)
        backward[:live, at - n] += value
    uses[-1] = 0
    return uses


def _fold(doc_id, parts: int):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts))


def _counted(labelled: DataFrame) -> DataFrame:
    """lang, word and how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for lang in sorted(set(langs)):
                seen: dict[str, int] = {}
                for w in letters.words([t for t, x in zip(texts, langs) if x == lang], LONGEST):
                    _, first, n = np.unique(w.hashes(w.begin, w.stop), return_index=True, return_counts=True)
                    text = w.cps.tobytes().decode("utf-32-le", "surrogatepass")
                    for a, b, k in zip(w.begin[first].tolist(), w.stop[first].tolist(), n.tolist()):
                        seen[text[a:b]] = seen.get(text[a:b], 0) + k
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    return labelled.mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def learn(spark: SparkSession, labelled: DataFrame, path: str) -> tuple[list[str], np.ndarray]:
    """Languages and piece probabilities (pieces, languages) from rows with doc_id, text, lang.

    At most SAMPLE documents of each language count, those of lowest hash.
    """
    ship(spark)
    different = stored(labelled.select("doc_id", "lang").distinct(), "labelled")
    texts = labelled.where(lowest(different, "doc_id", "lang", SAMPLE)).select("lang", "text")
    counted = stored(_counted(texts), "counted")
    langs = sorted(r[0] for r in counted.select("lang").distinct().collect())
    if not langs:
        return [], np.zeros((_table(path).size, 0))
    p = np.full((_table(path).size, len(langs)), 1.0 / _table(path).size)
    p[-1] = 0
    for _ in range(ROUNDS):

        def run(batches: Iterator[pa.RecordBatch], p=p) -> Iterator[pa.RecordBatch]:
            table, uses = _table(path), np.zeros(p.shape)
            for batch in batches:
                of = np.array([langs.index(x) for x in batch.column("lang").to_pylist()], np.int64)
                n = batch.column("n").to_numpy().astype(float)
                texts, done = batch.column("word").to_pylist(), 0
                for run_ in letters.groups(texts, letters.GROUP):
                    w = next(letters.words(run_))
                    begin = np.concatenate([[0], w.stops[:-1] + 1])
                    for k in range(len(langs)):
                        own = np.flatnonzero(of[done:done + len(run_)] == k)
                        if len(own):
                            uses[:, k] += _expected(w, begin[own], w.stops[own], n[done:done + len(run_)][own], table, p[:, k])
                    done += len(run_)
            piece, lang = np.nonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(uses[piece, lang])], ["piece", "lang", "uses"])

        rows = counted.mapInArrow(run, "piece bigint, lang bigint, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.zeros(p.shape)
        uses[rows["piece"], rows["lang"]] = rows["uses"]
        p = np.maximum(uses / np.maximum(uses.sum(0), 1e-9), LEAST)
        p[-1] = 0
    return langs, p


def identify(documents: DataFrame, langs: list[str], p: np.ndarray, path: str) -> DataFrame:
    """doc_id, lang_pred and score of every whole text.

    The score is the probability of the language among those learned, all taken as equally
    frequent. A null text, one without a letter, and any text where no language was learned, is
    ``und`` with score 0. Repeated rows stay; other columns are not carried along.
    """
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(path)
        for some, texts in parts(batches):
            names, scores = [], []
            for w in letters.words(texts, LONGEST):
                total = np.zeros((len(w.ends), max(1, len(langs))))
                if len(w.begin) and langs:
                    _, first, which = np.unique(w.hashes(w.begin, w.stop), return_index=True, return_inverse=True)
                    each = word_scores(w, w.begin[first], w.stop[first], table, p)
                    owner = w.owner()
                    for k in range(len(langs)):
                        total[:, k] = np.bincount(owner, each[which, k], len(w.ends))
                known = (np.diff(w.ends, prepend=0) > 0) & bool(langs)
                chance = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                names += [langs[i] if k else UNKNOWN for i, k in zip(total.argmax(1).tolist(), known.tolist())]
                scores += np.where(known, chance, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def held_out_identification(spark: SparkSession, documents: DataFrame, path: str) -> DataFrame:
    """Learns from three quarters of the labelled documents and identifies all."""
    fold = F.coalesce(_fold(F.col("doc_id"), 4) == 2, F.lit(False))
    train = documents.where("lang is not null and doc_id is not null").where(~fold).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    langs, p = learn(spark, train, path)
    return identify(documents, langs, p, path).select("doc_id", fold.alias("held_out"), "lang_pred", "score")
