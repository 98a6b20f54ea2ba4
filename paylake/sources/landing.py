"""Landing folder: Parquet by source, date and verdict, one canonical layout.

One write judges the rows: those that can be read land, the others lie beside them with their text
and a reason, as the partition ``verdict=rejected`` of the same date. So every input row is in one of
the two, and what a source delivers is computed once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paylake.fixed import CANONICAL_COLUMNS
from paylake.operators.partitions import replace_partitions
from paylake.operators.scratch import file_system

LANDED, REJECTED = "landed", "rejected"
READ = ("amount", "txn_timestamp")  # columns whose text may be unreadable
_SAID = {c: f"said_{c}" for c in READ}
LAYOUT = T.StructType([
    *[T.StructField(c, T.DoubleType() if c == "amount" else T.StringType()) for c in CANONICAL_COLUMNS],
    *[T.StructField(c, T.StringType()) for c in (*_SAID.values(), "reject_reason")],
    T.StructField("source", T.StringType()), T.StructField("date", T.DateType()), T.StructField("verdict", T.StringType())])


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in CANONICAL_COLUMNS if c not in df.columns]


def canonical(df: DataFrame, *keep: str) -> DataFrame:
    """The canonical columns in order, then ``keep``; missing ones null, others dropped."""
    absent = set(missing_columns(df))
    columns = [F.lit(None).cast("string").alias(c) if c in absent else F.col(c) for c in CANONICAL_COLUMNS]
    return df.select(*columns, *keep)


def _time(c: Column) -> Column:
    """Time of ISO or day-first text (05/01/2024 10:00, 05-01-2024), null where it is no time."""
    iso = F.regexp_replace(F.trim(c.cast("string")), r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})", "$3-$2-$1")
    return iso.try_cast("timestamp_ntz")


def coerced(df: DataFrame, *keep: str) -> DataFrame:
    """Amount as double and times as text to the second; what cannot be read becomes null."""
    return canonical(df, *keep).withColumns({
        "amount": F.col("amount").try_cast("double"),
        **{c: F.substring(_time(F.col(c)).cast("string"), 1, 19) for c in ("txn_timestamp", "ingested_at")},
    })


def unreadable(df: DataFrame) -> Column:
    """Why a row cannot be landed: texts for an amount or a time that cannot be read; else null."""
    bad = {"amount": F.col("amount").try_cast("double"), "txn_timestamp": _time(F.col("txn_timestamp"))}
    reasons = [
        F.when(F.col(c).isNotNull() & value.isNull(), F.concat(F.lit(f"{c} cannot be read: "), F.col(c).cast("string")))
        for c, value in bad.items() if c in df.columns]
    return F.nullif(F.array_join(F.array_compact(F.array(*reasons)), "; "), F.lit(""))


def judged(df: DataFrame, *keep: str) -> DataFrame:
    """Rows as they are stored: canonical columns, what a rejected row said, its reason, the verdict.

    A ``reject_reason`` that ``df`` has already, from reading it, comes before what is found here.
    """
    found = unreadable(df)
    why = F.coalesce(F.col("reject_reason"), found) if "reject_reason" in df.columns else found
    said = {name: F.when(F.col("_why").isNotNull(), F.col(c).cast("string")) if c in df.columns else F.lit(None).cast("string")
            for c, name in _SAID.items()}
    rows = df.withColumn("_why", why).withColumns(said)
    return coerced(rows, *said, "_why", *keep).withColumnRenamed("_why", "reject_reason").withColumn(
        "verdict", F.when(F.col("reject_reason").isNull(), LANDED).otherwise(REJECTED))


def land(df: DataFrame, root: str, source: str, date: dt.date) -> None:
    """Replace what landed for this source and date."""
    land_dates(df.withColumn("date", F.lit(date)), root, source, [date])


def land_dates(df: DataFrame, root: str, source: str, dates: Sequence[dt.date]) -> None:
    """Replace several dates of a source in one job; a ``date`` column tells each row's date."""
    replace_partitions(judged(df, "date"), f"{root}/source={source}", "date", dates, split=("verdict", (LANDED, REJECTED)))


def read_landing(spark: SparkSession, root: str, dates: Sequence[dt.date] | None = None) -> DataFrame:
    """All rows with their source, date and verdict, which come from the folder names.

    With ``dates``, only the folders of these are listed.
    """
    where = "source=*" if dates is None else f"source=*/date={{{','.join(map(str, dates))}}}"
    fs, pattern = file_system(spark, f"{root}/{where}")
    if not fs.globStatus(pattern):
        return spark.createDataFrame([], LAYOUT)
    return spark.read.schema(LAYOUT).option("basePath", root).parquet(f"{root}/{where}")


def landed(rows: DataFrame) -> DataFrame:
    """The rows that could be read."""
    return rows.where(F.col("verdict") == LANDED).drop(*_SAID.values(), "reject_reason", "verdict")


def text_of(rows: DataFrame, column: str) -> Column:
    """A column's text: what a rejected row said, else the value."""
    value = F.col(column).cast("string")
    name = _SAID.get(column)
    return F.coalesce(F.col(name), value) if name in rows.columns else value


def rejected(rows: DataFrame) -> DataFrame:
    """The rows that could not, as text, with their reason."""
    return rows.where(F.col("verdict") == REJECTED).withColumns({c: text_of(rows, c) for c in READ}).drop(*_SAID.values(), "verdict")


def read_landing_date(spark: SparkSession, root: str, date: dt.date) -> DataFrame:
    """What landed for one date."""
    return landed(read_landing(spark, root, [date]))


def origin_from_path(path: Column) -> Column:
    return F.when(path.ilike("%source=csv%"), F.lit("csv")).otherwise(F.lit("api"))
