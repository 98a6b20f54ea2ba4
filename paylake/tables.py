"""Where tables live and how they are replaced."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from paylake.config import Run, namespace
from paylake.functions.audit import with_audit
from paylake.operators import versioned
from paylake.operators.partitions import by_partition, replace_partitions, table_exists
from paylake.sources import raw

# Schema folder of every table; None stands for the default schema.
SCHEMAS = {
    "raw_upi_transactions": "raw_layer",
    "stg_upi_transactions": "staging",
    "int_customers_current": "intermediate",
    "snp_customers": "snapshots",
    "fct_customer_activity": "mart_customer",
    "fct_transactions": "mart_transaction",
    "fct_daily_summary": "mart_transaction",
    "fct_fraud_signals": "mart_fraud",
    "fct_fraud_scores": "mart_fraud",
    "fct_fraud_summary": "mart_fraud",
    "dq_results": None,
    "run_metrics": None,
    # What marts go on from: transactions by sender and day, and the customer versions that facts show.
    "sender_days": "mart_transaction",
    "fact_versions": "mart_transaction",
}
# The scores have no day of their own; they are stored by one.
_HIDDEN = {"fct_fraud_scores": ("txn_date",)}
# Raw tables and the customer history keep one name in every target.
_FIXED = ("raw_layer", "snapshots")
# Rejected rows lie in a partition of the raw table.
_STORED_IN = {"raw_rejects": "raw_upi_transactions"}


@dataclass(frozen=True)
class Tables:
    spark: SparkSession
    root: str
    run: Run
    default_schema: str = "analytics"

    def path(self, table: str) -> str:
        schema = SCHEMAS[table]
        folder = schema if schema in _FIXED else namespace(schema, self.run.target, self.default_schema)
        return f"{self.root}/{folder}/{table}"

    def folder(self, table: str) -> str:
        """Where the rows of a table lie now: its current version, or the folder itself."""
        return versioned.current(self.spark, self.path(table)) or self.path(table)

    def exists(self, table: str) -> bool:
        return table_exists(self.spark, self.folder(_STORED_IN.get(table, table)))

    def read(self, table: str) -> DataFrame:
        if table == "raw_upi_transactions":
            return raw.read_raw(self.spark, self.path(table))
        if table == "raw_rejects":
            return raw.read_rejects(self.spark, self.path(_STORED_IN[table]))
        return self.spark.read.parquet(self.folder(table)).drop(*_HIDDEN.get(table, ()))

    def replace_days(self, df: DataFrame, table: str, day: str, days: Sequence) -> None:
        """Make the rows the whole content of these days of the table's current version."""
        replace_partitions(with_audit(df, self.run, table), self.folder(table), day, days)

    def replace(self, df: DataFrame, table: str, day: str | None = None) -> None:
        """Replace the whole table, by day if it has one, with audit columns.

        Readers see the old table until the new one is complete.
        """
        rows = with_audit(df, self.run, table)

        def write(folder: str) -> None:
            if day:
                by_partition(rows, day).write.partitionBy(day).parquet(folder)
                if not table_exists(self.spark, folder):  # a table without a row keeps its columns
                    rows.drop(day).limit(0).write.parquet(f"{folder}/{day}={self.run.run_date}")
            else:
                rows.write.parquet(folder)

        versioned.replace(self.spark, self.path(table), write)
