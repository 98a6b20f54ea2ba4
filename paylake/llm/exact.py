"""Exact deduplication by recipes of content-defined chunks.

Each normalised text is cut where its content says so, and a chunk is known by a 64-bit
identifier. A dictionary of chunks verifies the identifiers: it compares all chunks of one
identifier by a check value of their SHA-256. Two texts are equal if their ordered lists of
identifiers are, unless a list holds an identifier that failed; such texts are compared by their
own SHA-256 as well. Only lists of identifiers are shuffled: 16 bytes for some 300 characters, and
never a text. A group of copies is one row after partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.operators.scratch import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A chunk has 256 characters at least, then ends after the first blank that follows "e" or "n" and
#: one more letter or comma, and has 2,048 characters at most. What is left of a text is a chunk.
CHUNK = r"(?s).{256,2047}?(?<=[en][^ ]\s)|.{1,2048}"


def normalised(text: Column) -> Column:
    """Lower case for A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def recipes(documents: DataFrame) -> DataFrame:
    """doc_id, text_sha256, identifiers of the chunks in order and their check values."""
    chunks = documents.select("doc_id", normalised(F.col("text")).alias("t")).select(
        "doc_id", F.sha2("t", 256).alias("text_sha256"), F.regexp_extract_all("t", F.lit(CHUNK), F.lit(0)).alias("chunks"))
    return chunks.select(
        "doc_id", "text_sha256", F.transform("chunks", lambda c: F.xxhash64(c)).alias("recipe"),
        F.transform("chunks", lambda c: F.xxhash64(F.sha2(c, 256))).alias("checks"))


def dictionary(listed: DataFrame) -> DataFrame:
    """chunk, its number of occurrences and whether all of them have one check value."""
    each = listed.select(F.explode(F.arrays_zip("recipe", "checks")).alias("c")).select("c.recipe", "c.checks")
    return each.groupBy(F.col("recipe").alias("chunk")).agg(
        F.count("*").alias("occurrences"), (F.min("checks") == F.max("checks")).alias("verified"))


def deduplicate(documents: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document.

    Texts that are equal but for the case of A-Z form a group, of which the largest doc_id stays; a
    null or empty text is equal to other such texts. Repeated rows count each, and all rows of the
    id that stays are kept; a null id stays only where a group has no other. Other columns are not
    carried along, and an empty table gives an empty one.
    """
    listed = stored(recipes(documents), "recipes")
    failed = stored(dictionary(listed).where(~F.col("verified")).select("chunk"), "failed")
    marked = listed.select("doc_id", "text_sha256", "recipe")
    if failed.isEmpty():  # every identifier stands for one chunk
        marked = marked.withColumn("doubt", F.lit(None).cast("string"))
    else:
        doubtful = listed.select("text_sha256", F.explode("recipe").alias("chunk")).join(failed, "chunk", "left_semi").select(
            F.col("text_sha256").alias("doubt")).distinct()
        marked = stored(marked.join(doubtful, F.col("text_sha256") == F.col("doubt"), "left"), "marked")
    groups = marked.groupBy("recipe", "doubt").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).select(
        F.col("recipe").alias("r"), F.col("doubt").alias("d"), "keep_id", "group_size")
    same = (F.col("recipe") == F.col("r")) & F.col("doubt").eqNullSafe(F.col("d"))
    return marked.join(groups, same).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
