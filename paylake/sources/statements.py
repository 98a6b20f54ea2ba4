"""Statement files: CSV whose headers differ from file to file."""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from paylake.config import Run
from paylake.fixed import CANONICAL_COLUMNS, DEFAULT_CURRENCY, HEADER_ALIASES, NULL_SPELLINGS
from paylake.operators.latest import first_per_key
from paylake.sources.landing import land_dates
from paylake.sources.ledger import PROFILE, record

_PLACE = ("_file", "_block", "_row")
_SPARE, _FAULT = "_spare", "_fault"
_DATE = r"\d{4}-\d{2}-\d{2}"
_NAME = r"([^/]*\.csv)(?:/[^/]*)?$"  # a file, or a folder of parts that a writer named so


def statement_files(spark: SparkSession, folder: str, dates: Sequence[dt.date]) -> list[str]:
    """Files named ``*<date>*.csv``, sorted. Only names are read, not contents."""
    try:
        found = spark.read.format("binaryFile").load(f"{folder}/*{{{','.join(map(str, dates))}}}*.csv").select("path")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r[0] for r in found.collect())


def _by_header(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header, from one job that keeps the first line of each file."""
    if not files:
        return {}
    lines = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value", F.monotonically_increasing_id().alias("at"))
    first = lines.where("start = 0 and trim(value) <> ''").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, line in sorted((unquote(r[0]), r[1]) for r in first.collect()):
        groups[tuple(next(csv.reader([line.removeprefix("\ufeff")])))].append(path)
    return groups


def _names(header: tuple[str, ...]) -> list[str]:
    """Canonical or own names of the columns of a header."""
    return [HEADER_ALIASES.get(n, n) for n in (raw_name.strip().lower() for raw_name in header)]


def _dated(path: Column, dates: Sequence[dt.date]) -> Column:
    """The wanted dates that the name of a file, or of the folder it is a part of, holds."""
    name = F.regexp_extract(path, _NAME, 1)
    return F.array_intersect(F.regexp_extract_all(name, F.lit(f"({_DATE})"), F.lit(1)), F.array(*[F.lit(str(d)) for d in dates])).cast("array<date>")


def _read_layout(spark: SparkSession, header: tuple[str, ...], files: list[str], multi_line: bool) -> DataFrame:
    """Files of one header as canonical text columns plus the place and the fault of each row.

    Columns of one name, whether repeated or by alias, fill each other's gaps from left to right.
    """
    places = [f"_c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*places, _SPARE]])
    rows = spark.read.schema(schema).options(header=True, escape='"', multiLine=multi_line, enforceSchema=True).csv(files)

    by_name: dict[str, list] = defaultdict(list)
    for place, name in zip(places, _names(header)):
        by_name[name].append(F.when(~F.col(place).isin(list(NULL_SPELLINGS)), F.col(place)))
    # The currency default needs the column to be there; staging fills what is left.
    if "currency" in by_name:
        by_name["currency"].append(F.lit(DEFAULT_CURRENCY))
    columns = [
        (F.coalesce(*by_name[c]) if c in by_name else F.lit(None).cast("string")).alias(c) for c in CANONICAL_COLUMNS
    ]
    place = (F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    # A filled spare column means that the line has more fields than the header.
    fault = F.when(F.col(_SPARE).isNotNull(), F.lit(f"more than {len(header)} fields")).alias(_FAULT)
    return rows.select(*columns, fault, *[p.alias(n) for p, n in zip(place, _PLACE)])


def read_lines(spark: SparkSession, folder: str, dates: Sequence[dt.date], multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """All lines of the files of some dates, with their ``date``, and the column profile of each file.

    Headers are read once, then there is one scan per distinct header, whatever the number of files
    and dates. A file whose name holds several of the dates belongs to each.
    """
    groups = _by_header(spark, statement_files(spark, folder, dates))
    wanted = {str(d): d for d in dates}
    profiles = [
        (wanted[day], path, sorted(set(_names(header)))) for header, files in groups.items() for path in files
        for day in sorted(wanted.keys() & set(re.findall(_DATE, re.search(_NAME, path)[1])))]
    parts = [_read_layout(spark, header, files, multi_line) for header, files in sorted(groups.items())]
    if parts:
        lines = reduce(DataFrame.unionByName, parts)
    else:
        kinds = dict.fromkeys([*CANONICAL_COLUMNS, _FAULT, _PLACE[0]], "string") | dict.fromkeys(_PLACE[1:], "bigint")
        lines = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in kinds.items()))
    return lines.withColumn("date", F.explode(_dated(F.col(_PLACE[0]), dates))), spark.createDataFrame(profiles, PROFILE)


def first_lines(lines: DataFrame, run: Run) -> DataFrame:
    """First line of each transaction id and date, by file name, then by place in the file.

    Lines that could not be read stay, each with its ``reject_reason``, and are not counted as copies.
    """
    own = F.when(F.col(_FAULT).isNotNull(), F.struct(*_PLACE))
    first = first_per_key(lines.withColumn("_own", own), ["date", "txn_id", "_own"], [F.col(p) for p in _PLACE])
    stamped = first.withColumn("ingested_at", F.lit(run.run_ts.strftime("%Y-%m-%d %H:%M:%S")))
    return stamped.withColumnRenamed(_FAULT, "reject_reason").drop(*_PLACE, "_own")


def read_statements(spark: SparkSession, folder: str, run: Run, multi_line: bool = False) -> DataFrame:
    """Rows of all statement files of the run date, first row of each transaction id kept.

    Lines with more fields than their header are left out here; landing keeps them with their reason.
    Quoted line breaks need ``multi_line``, which gives up splitting large files.
    """
    lines, _ = read_lines(spark, folder, [run.run_date], multi_line)
    return first_lines(lines, run).where("reject_reason is null").drop("reject_reason", "date")


def land_statements(spark: SparkSession, folder: str, root: str, run: Run, dates: Sequence[dt.date] | None = None) -> None:
    """Land the run date, or all of ``dates`` at once, and record which columns each file had."""
    dates = [run.run_date] if dates is None else list(dates)
    lines, profiles = read_lines(spark, folder, dates)
    record(profiles, root, "csv", dates)
    land_dates(first_lines(lines, run), root, "csv", dates)
