"""Age of the newest raw row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from paylake.config import Run
from paylake.functions.calendar import ntz


def freshness(raw: DataFrame, run: Run, now: dt.datetime | None = None) -> DataFrame:
    """Newest load time and pass, warn or error by its age; no rows at all is an error."""
    now = now or run.run_ts
    warn = ntz(now - dt.timedelta(hours=run.settings.freshness_warn_hours))
    error = ntz(now - dt.timedelta(hours=run.settings.freshness_error_hours))
    newest = F.col("newest_ingested_at")
    return raw.agg(F.max("ingested_at").alias("newest_ingested_at")).withColumn(
        "freshness", F.when(newest.isNull() | (newest < error), "error").when(newest < warn, "warn").otherwise("pass"))
