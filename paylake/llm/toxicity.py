"""Toxicity by weak supervision.

Voters fire on texts: one for each word of a fixed lexicon, and one for each pattern, a word or a
beginning of words that occurs once, twice or three times, which labelled training documents show
to go with toxic texts. A text on which no voter fires has a vote against, and the label that the
document was given is a vote like the others. A generative model with two hidden classes estimates
every voter's accuracy by expectation maximisation; a voter that does not fire abstains. What voters
agree beyond that, given the class, is their correlation, and voters that repeat each other share
their weight. A linear classifier on the votes then learns the posterior labels and scores every
whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.llm import letters, linear
from paylake.llm.batches import parts
from paylake.llm.sampling import lowest
from paylake.llm.workers import ship
from paylake.operators.scratch import stored

# A short lexicon of insults.
LEXICON = ("clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless")

TOXIC_SAMPLE = 4_000  # labelled toxic documents that patterns and weights are learned from
CLEAN_SAMPLE = 8_000  # and labelled clean ones
STEMS = (4, 5, 6, 7)  # letters of the beginnings of words that may become patterns
TIMES = (1, 2, 3)  # occurrences in a document from which on a pattern fires
CANDIDATES = 20_000  # patterns most frequent in toxic documents that are compared with clean ones
VOTERS = 300
PRECISION = 0.8  # of a pattern, in the sample
ROUNDS = 30


@dataclass
class Model:
    """Voters by hash, letters (0: a whole word) and times, and the classifier's weights."""

    hashes: np.ndarray
    stems: np.ndarray
    times: np.ndarray
    weights: np.ndarray


def _features(w: letters.Words) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Letters, hash and word number of the whole words and of the beginnings of longer words."""
    size = w.stop - w.begin
    yield 0, w.hashes(w.begin, w.stop), np.arange(len(size))
    for n in STEMS:
        long = np.flatnonzero(size > n)
        yield n, w.hashes(w.begin[long], w.begin[long] + n), long


def _in_documents(batches: Iterator[pa.RecordBatch], only: dict[int, np.ndarray] | None) -> Iterator[pa.RecordBatch]:
    """stem, times, hash and the number of documents that have it so often, for each part of a batch."""
    for _, texts in parts(batches):
        found = []
        for w in letters.words(texts):
            owner = w.owner()
            for n, h, of in _features(w):
                if only is not None:
                    some = np.isin(h, only.get(n, np.zeros(0, np.uint64)))
                    h, of = h[some], of[some]
                if not len(h):
                    continue
                order = np.lexsort((owner[of], h))
                h, doc = h[order], owner[of][order]
                new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]))
                often = np.diff(new, append=len(h))
                for times in TIMES:
                    value, k = np.unique(h[new[often >= times]], return_counts=True)
                    found.append((np.full(len(value), n), np.full(len(value), times), value.view(np.int64), k))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["stem", "times", "hash", "n"])


def _document_counts(texts: DataFrame, only: dict[int, np.ndarray] | None = None) -> DataFrame:
    rows = texts.select("text").mapInArrow(lambda it: _in_documents(it, only), "stem bigint, times bigint, hash bigint, n bigint")
    return rows.groupBy("stem", "times", "hash").agg(F.sum("n").alias("n"))


def _votes(texts: list[str], hashes: np.ndarray, stems: np.ndarray, times: np.ndarray) -> Iterator[np.ndarray]:
    """For each group of texts, which voters fire: (texts, voters)."""
    by_kind = {(int(n), int(t)): np.flatnonzero((stems == n) & (times == t)) for n in np.unique(stems) for t in np.unique(times)}
    for w in letters.words(texts):
        owner, found = w.owner(), np.zeros((len(w.ends), len(hashes)), np.int32)
        for n, h, of in _features(w):
            for t in TIMES:
                own = by_kind.get((n, t), ())
                if not len(own) or not len(h):
                    continue
                order = own[np.argsort(hashes[own])]
                at = np.minimum(np.searchsorted(hashes[order], h), len(order) - 1)
                hit = np.flatnonzero(hashes[order][at] == h)
                np.add.at(found, (owner[of[hit]], order[at[hit]]), 1)
        yield found >= times


def _voters(toxic: DataFrame, clean: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, stems and times of the lexicon and of the most telling patterns of the sample."""
    n_toxic, n_clean = toxic.count(), clean.count()
    voters = [(letters.hash_of(x), 0, 1) for x in LEXICON]
    if n_toxic and n_clean:
        key = ["stem", "times", "hash"]
        least = max(3, n_toxic // 200)
        rows = _document_counts(toxic).where(F.col("n") >= least).orderBy(F.desc("n"), *key).limit(CANDIDATES).toPandas()
        only = {int(n): np.unique(g["hash"].to_numpy(np.int64).view(np.uint64)) for n, g in rows.groupby("stem")}
        other = _document_counts(clean, only).toPandas().rename(columns={"n": "clean"})
        rows = rows.merge(other, on=key, how="left").fillna({"clean": 0})
        rows["precision"] = rows["n"] / (rows["n"] + rows["clean"] * (n_toxic / n_clean) + 0.5)
        rows["gain"] = rows["n"] / n_toxic - 5 * rows["clean"] / n_clean
        rows = rows[rows["precision"] >= PRECISION].sort_values(["gain", *key], ascending=[False, True, True, True]).head(VOTERS)
        for h, n, t in zip(rows["hash"].to_numpy(np.int64).view(np.uint64).tolist(), rows["stem"].tolist(), rows["times"].tolist()):
            if (h, n, t) not in voters:
                voters.append((h, n, t))
    h, n, t = zip(*voters)
    return np.array(h, np.uint64), np.array(n), np.array(t)


def label_model(fires: np.ndarray, given: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Posterior of the toxic class for votes (documents, voters), given labels and row weights.

    Accuracies are estimated twice: with all voters counting alike, and again with each weighted by
    1 / (1 + the sum of its positive correlations with the others given the class).
    """
    silent = ~fires.any(1)
    votes = np.hstack([fires, silent[:, None]]).astype(float)
    weight = np.ones(votes.shape[1])
    for again in range(2):
        q, right = np.where(given == 1, 0.9, 0.1), 0.9
        for _ in range(ROUNDS):
            prior = np.clip(np.average(q, weights=rows), 1e-3, 1 - 1e-3)
            base = np.log(prior / (1 - prior))
            mass = rows @ votes
            accuracy = np.clip(((rows * q) @ votes + prior) / (mass + 1), 1e-3, 1 - 1e-3)
            told = np.log(right / (1 - right)) * np.where(given == 1, 1, -1)
            odds = base + told + votes @ (weight * (np.log(accuracy / (1 - accuracy)) - base))
            new = linear.sigmoid(odds)
            moved, q = np.abs(new - q).max(), new
            right = float(np.clip(np.average(np.where(given == 1, q, 1 - q), weights=rows), 0.6, 0.99))
            if moved < 1e-4:
                break
        rate = np.stack([((1 - q) * rows) @ votes / max(((1 - q) * rows).sum(), 1e-9), (q * rows) @ votes / max((q * rows).sum(), 1e-9)])
        left = votes - (np.outer(1 - q, rate[0]) + np.outer(q, rate[1]))
        spread = np.maximum(left.std(0), 1e-6)
        shared = (left.T @ left) / len(left) / np.outer(spread, spread)
        np.fill_diagonal(shared, 0)
        weight = 1 / (1 + np.where(shared > 0.1, shared, 0).sum(1))
    return q


def learn(documents: DataFrame, labels: DataFrame) -> Model:
    """Voters, label model and classifier from documents (doc_id, text) and labels (doc_id, toxic 0 or 1).

    At most TOXIC_SAMPLE and CLEAN_SAMPLE documents count, those of lowest hash; they stand for all
    labelled ones of their class. Null ids and other labels are left out. The documents are chosen by
    their ids; no text moves but those that were chosen.
    """
    ship(documents.sparkSession)
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("bigint").alias("id"), F.col("toxic").cast("int").alias("label")).distinct()
    present = documents.select(F.col("doc_id").cast("bigint").alias("id")).where("id is not null")
    ids = stored(present.join(known, "id"), "labelled")
    all_of = {int(r[0]): r[1] for r in ids.groupBy("label").count().collect()}
    different = ids.distinct()
    chosen = stored(different.where(lowest(different, "id", "label", {1: TOXIC_SAMPLE, 0: CLEAN_SAMPLE})), "chosen")
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = stored(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("id")).select("doc_id", "text", "label"), "sample")
    hashes, stems, times = _voters(sample.where("label = 1"), sample.where("label = 0"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, texts in parts(batches):
            doc, voter = np.nonzero(np.concatenate([*_votes(texts, hashes, stems, times)]))
            each = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
            votes = pa.ListArray.from_arrays(pa.array(each), pa.array(voter.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), some.column("label"), votes], ["doc_id", "label", "votes"])

    rows = sample.mapInArrow(run, "doc_id bigint, label int, votes array<int>").toPandas()
    if rows.empty or rows["label"].nunique() < 2:  # the lexicon alone
        return Model(hashes, stems, times, np.append(np.full(len(hashes), 3.0), -4.0))
    rows = rows.sort_values(["doc_id", "label"], kind="stable")
    fires = np.zeros((len(rows), len(hashes)), bool)
    for i, voters in enumerate(rows["votes"]):
        fires[i, voters] = True
    given = rows["label"].to_numpy()
    stands_for = np.where(given == 1, all_of[1] / max(1, (given == 1).sum()), all_of[0] / max(1, (given == 0).sum()))
    stands_for = stands_for / stands_for.min()
    posterior = label_model(fires, given, stands_for)
    return Model(hashes, stems, times, linear.fit(fires.astype(float), posterior, stands_for))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every whole text.

    A null or empty text fires no voter and has the score of such texts. Repeated rows stay; other
    columns are not carried along, and an empty table gives an empty one.
    """
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, texts in parts(batches):
            votes = _votes(texts, model.hashes, model.stems, model.times)
            chance = [linear.sigmoid(linear.apply(v.astype(float), model.weights)) for v in votes]
            yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(np.concatenate(chance))], ["doc_id", "score"])

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, score double").select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def held_out_toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from four fifths of the labelled documents and scores all."""
    fold = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    model = learn(documents, labels.where(~fold))
    return score(documents, model).select("doc_id", fold.alias("held_out"), "score", "predicted")
