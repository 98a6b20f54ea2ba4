"""Staging kept up to date from the files that land, as a stream.

A file-source stream takes the files of the landing folder that it has not seen. Every batch is kept
under its number and merged into staging: all copies of its transactions, of this batch and of earlier
ones, are staged anew, so the latest copy wins in whatever order the files come. No state has to be
kept for late files, and a batch that is run again after a failure changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from paylake.config import Run
from paylake.operators.scratch import stored_for
from paylake.operators.upsert import upsert
from paylake.plans import staging
from paylake.sources import landing, raw as raw_table


def _merge(rows: DataFrame, number: int, raw_path: str, stg_path: str, run: Run) -> None:
    spark = rows.sparkSession
    rows = rows.where(F.col("verdict") == landing.LANDED)
    raw_table.accepted(rows).write.mode("overwrite").parquet(f"{raw_path}/batch={number}")
    raw = spark.read.parquet(raw_path)
    arrived = F.trim("txn_id")
    keys = raw.where((F.col("batch") == number) & F.col("txn_id").isNotNull()).select(arrived.alias("_arrived")).distinct()
    # A batch made again after later ones must not see them; copies are those up to its number.
    copies = raw.where(F.col("batch") <= number).join(keys, arrived == F.col("_arrived"), "left_semi").drop("batch")
    with stored_for(staging.stage(copies, run), "staged") as staged:
        gone = keys.select(F.col("_arrived").alias("txn_id")).join(staged.select("txn_id"), "txn_id", "left_anti")
        upsert(staged, stg_path, "txn_id", "txn_date", removed=gone)


def stage_stream(spark: SparkSession, root: str, raw_path: str, stg_path: str, checkpoint: str, run: Run, files: int | None = None) -> StreamingQuery:
    """Merge what has landed under ``root`` and was not merged before, then stop.

    ``files``: how many files a batch takes at most. The checkpoint knows which files are done.
    """
    source = spark.readStream.schema(landing.LAYOUT).option("basePath", root)
    if files:
        source = source.option("maxFilesPerTrigger", files)
    rows = source.parquet(f"{root}/source=*")
    return rows.writeStream.foreachBatch(lambda df, number: _merge(df, number, raw_path, stg_path, run)).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
