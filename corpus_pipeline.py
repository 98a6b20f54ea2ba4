"""From raw documents to token ids: reject, deduplicate, mix, encode."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paylake.llm import bpe, exact, jaccard, mixing, quality
from paylake.operators.scratch import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject.

    Null columns are values of their own, repeated rows are judged alike, and where a class has no
    labelled document, or no document is left, nothing is rejected.
    """
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, "_quality").where("_quality.combined >= 0.5").select(*docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id.

    A null text equals an empty one; a null id stays only where its group has no other. Rows that
    repeat both id and text become one. An empty table stays empty.
    """
    decided = stored(exact.deduplicate(docs), "decided")
    key = ["_id", "_sha"]
    rows = docs.withColumn("_id", F.col("doc_id")).withColumn("_sha", F.sha2(exact.normalised(F.col("text")), 256))

    def matching(some: DataFrame, how: str) -> DataFrame:
        some = some.select(F.col("doc_id").alias("i"), F.col("text_sha256").alias("t")).distinct()
        return rows.join(some, F.col("_id").eqNullSafe(F.col("i")) & (F.col("_sha") == F.col("t")), how)

    kept = matching(decided.where("not kept"), "left_anti")
    again = decided.where("kept").groupBy("doc_id", "text_sha256").count().where("count > 1")
    if not again.isEmpty():  # rows that repeat both id and text
        repeated = stored(again, "again")
        kept = matching(decided.where("not kept").unionByName(repeated, allowMissingColumns=True), "left_anti").unionByName(
            matching(repeated, "left_semi").dropDuplicates(key))
    return kept.select(*docs.columns)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by runs of five words and a similarity of 0.8.

    The one of the smallest id stays. Documents without words or without an id are near copies of
    nothing and stay; an empty table stays empty.
    """
    found = jaccard.near_duplicates(docs, jaccard.Similarity(5, 80))
    dropped = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, F.col("doc_id") == F.col("_dropped"), "left_anti").select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    A null source is one more source, the last; a text without words takes nothing from a budget.
    Rows of one id have one place, so they are taken alike. An empty table stays empty.
    """
    taken = mixing.mix(docs.select("*"), mixing.budgets(mixing.sizes(docs))).where("times > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded bytes of what is left.

    A null text has no tokens and the digests of nothing; repeated rows stay, a row each.
    """
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", no_near_copies),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; the shared folder keeps them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
