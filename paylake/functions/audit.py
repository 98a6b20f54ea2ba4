"""Audit columns stamped on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paylake.config import Run
from paylake.functions.calendar import ntz

AUDIT_COLUMNS = ("_dbt_inserted_at", "_dbt_invocation_id", "_dbt_model", "_dbt_target")


def with_audit(df: DataFrame, run: Run, table: str) -> DataFrame:
    stamps = (ntz(run.run_ts), F.lit(run.invocation_id), F.lit(table), F.lit(run.target))
    return df.withColumns(dict(zip(AUDIT_COLUMNS, stamps)))
