"""Ledger of arrivals: which columns every delivered file had, before the landing made them canonical.

A row per source, date and file. The columns come from the scan that reads the file: the header of
a statement, the names in the records of a page. A column that is missing and cannot be done without
stops its date; others are told.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paylake.fixed import CANONICAL_COLUMNS, REQUIRED_COLUMNS
from paylake.operators.partitions import replace_partitions, table_exists

PROFILE = "date date, file string, columns array<string>"
ENTRY = "file string, missing array<string>, extra array<string>, source string, date date"
# Statements have no ingestion time of their own; the run stamps it.
EXPECTED = {"csv": tuple(c for c in CANONICAL_COLUMNS if c != "ingested_at"), "api": CANONICAL_COLUMNS}


def ledger_root(root: str) -> str:
    return f"{root.rstrip('/')}_columns"


def entries(profiles: DataFrame, source: str) -> DataFrame:
    """date, file, missing and extra columns from profiles (date, file, columns)."""
    def texts(names: Sequence[str]) -> Column:
        return F.array(*[F.lit(c) for c in names])

    return profiles.select(
        "date", "file", F.array_except(texts(EXPECTED[source]), "columns").alias("missing"),
        F.array_sort(F.array_except("columns", texts(CANONICAL_COLUMNS))).alias("extra"))


def record(profiles: DataFrame, root: str, source: str, dates: Sequence[dt.date]) -> None:
    """Replace the entries of these dates."""
    replace_partitions(entries(profiles, source), f"{ledger_root(root)}/source={source}", "date", dates)


def read_ledger(spark: SparkSession, root: str, dates: Sequence[dt.date] | None = None) -> DataFrame:
    path = ledger_root(root)
    if not table_exists(spark, path):
        return spark.createDataFrame([], ENTRY)
    rows = spark.read.schema(ENTRY).option("basePath", path).parquet(f"{path}/source=*")
    return rows if dates is None else rows.where(F.col("date").isin(list(dates)))


def drift(ledger: DataFrame) -> DataFrame:
    """date, schema_drift (every difference once, by source) and whether one of them stops the date."""
    def told(sign: str, column: str) -> Column:
        return F.transform(column, lambda c: F.concat(F.col("source"), F.lit(f":{sign}"), c))

    stops = F.arrays_overlap("missing", F.array(*[F.lit(c) for c in REQUIRED_COLUMNS]))
    each = ledger.select("date", stops.alias("stops"), F.explode_outer(F.concat(told("-", "missing"), told("+", "extra"))).alias("difference"))
    return each.groupBy("date").agg(
        F.array_join(F.array_sort(F.collect_set("difference")), ",").alias("schema_drift"), F.max("stops").alias("stops"))
