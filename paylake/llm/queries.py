"""The registered queries of the operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from paylake.llm import bpe, exact, jaccard, language, merkle, mixing, negatives, oracle, quality, secrets, token_counts, token_files, toxicity, vectors

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out_quality(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_toxicity(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_and_read(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), added=True)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_identification(spark, _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"), jaccard.Similarity(words=4, percent=85))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mined(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    operators = (
        op1_byte_bpe, op2_secret_scan, op3_quality, op4_exact_dedup, op5_mixing, op6_toxicity, op7_embedding_dedup, op8_token_files, op9_language_id,
        op10_jaccard_join, op11_token_counts, op12_hard_negatives, op13_merkle_manifest)
    return {f.__name__: f for f in operators} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_secret_scan": oracle.SECRETS, "op4_exact_dedup": oracle.EXACT, "op5_mixing": oracle.MIXING,
        "op7_embedding_dedup": oracle.EMBEDDINGS, "op10_jaccard_join": oracle.JACCARD,
        "op12_hard_negatives": oracle.NEGATIVES, "op13_merkle_manifest": oracle.MERKLE}
