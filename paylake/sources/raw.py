"""Raw table: typed rows by source date; rows that break a type or limit lie beside them.

One write deals the rows of a date to two folders, ``verdict=accepted`` and ``verdict=rejected``, so
what landed is read once. A rejected row keeps its texts and the reason.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paylake.fixed import CANONICAL_COLUMNS, DEFAULT_CURRENCY, RAW_TEXT_LIMITS
from paylake.operators.partitions import partition_rows, replace_partitions
from paylake.sources.landing import text_of

RAW_TYPES = {c: "string" for c in CANONICAL_COLUMNS} | {
    "amount": "decimal(15,2)", "txn_timestamp": "timestamp_ntz", "ingested_at": "timestamp_ntz",
}
ACCEPTED, REJECTED = "accepted", "rejected"


def _faults() -> dict[str, Column]:
    faults = {"txn_id is null": F.col("txn_id").isNull()}
    for name, limit in RAW_TEXT_LIMITS.items():
        faults[f"{name} over {limit}"] = F.length(name) > limit
    for name, kind in RAW_TYPES.items():
        if kind != "string":
            unreadable = F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
            faults[f"{name} not {kind.split('(')[0]}"] = unreadable
    return faults


def sorted_out(rows: DataFrame) -> DataFrame:
    """Rows as the table stores them: typed where they are accepted, else text and a reason in ``refused``.

    A ``reject_reason`` that a row has from its landing stands.
    """
    named = [F.when(bad, F.lit(text)) for text, bad in _faults().items()]
    found = F.nullif(F.array_join(F.array_compact(F.array(*named)), "; "), F.lit(""))
    why = F.coalesce(F.col("reject_reason"), found) if "reject_reason" in rows.columns else found
    rows = rows.withColumn("_why", why)
    good = F.col("_why").isNull()

    def typed(c: str) -> Column:
        value = F.coalesce("currency", F.lit(DEFAULT_CURRENCY)) if c == "currency" else F.col(c).try_cast(RAW_TYPES[c])
        return F.when(good, value).alias(c)

    refused = F.struct(*[text_of(rows, c).alias(c) for c in CANONICAL_COLUMNS], F.col("_why").alias("reject_reason"))
    return rows.select(
        *[typed(c) for c in CANONICAL_COLUMNS], F.col("date").cast("date").alias("_source_date"), F.col("source").alias("_source"),
        F.when(~good, refused).alias("refused"), F.when(good, ACCEPTED).otherwise(REJECTED).alias("verdict"))


def accepted(rows: DataFrame) -> DataFrame:
    """Rows the raw table takes, typed, with source and source date."""
    return _accepted(sorted_out(rows))


def rejects(rows: DataFrame) -> DataFrame:
    return _rejected(sorted_out(rows))


def _accepted(table: DataFrame) -> DataFrame:
    return table.where(F.col("verdict") == ACCEPTED).drop("refused", "verdict").select(*CANONICAL_COLUMNS, "_source_date", "_source")


def _rejected(table: DataFrame) -> DataFrame:
    return table.where(F.col("verdict") == REJECTED).select(
        *[f"refused.{c}" for c in CANONICAL_COLUMNS], "_source_date", "_source", "refused.reject_reason")


def load(rows: DataFrame, raw_path: str, dates: Sequence[dt.date]) -> dict[str, int]:
    """Replace the given source dates with what arrived for them; returns accepted rows by date.

    ``rows`` are those of the landing folder, rejected ones included. Rows are sorted by time inside
    each file, so scans by time skip row groups.
    """
    replace_partitions(sorted_out(rows), raw_path, "_source_date", dates, "txn_timestamp", split=("verdict", (ACCEPTED, REJECTED)))
    return partition_rows(read_raw(rows.sparkSession, raw_path), "_source_date", dates)


def read_raw(spark: SparkSession, raw_path: str) -> DataFrame:
    return _accepted(spark.read.parquet(raw_path))


def read_rejects(spark: SparkSession, raw_path: str) -> DataFrame:
    return _rejected(spark.read.parquet(raw_path))
