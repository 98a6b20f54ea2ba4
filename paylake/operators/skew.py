"""Keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paylake.config import SkewPolicy
from paylake.operators.scratch import stored


def hot_keys(df: DataFrame, keys: dict[str, Column], policy: SkewPolicy) -> DataFrame | None:
    """Keys above the policy's share of ``df``, or None where there are none.

    Fewer than ``policy.max_keys`` rows by construction, so the result may be broadcast.
    The counts combine before the shuffle; the list is written since plans reuse it.
    """
    rows = df.count()
    if rows <= policy.min_rows:
        return None
    counts = df.select(*[c.alias(n) for n, c in keys.items()]).groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = stored(_above(counts, "_n", rows, policy), "hot-keys")
    return None if hot.isEmpty() else hot


def _above(counts: DataFrame, count: str, rows: int, policy: SkewPolicy) -> DataFrame:
    return counts.where(F.col(count) > max(policy.min_rows, rows // policy.max_keys)).drop(count)


def flag_hot(df: DataFrame, hot: DataFrame, flag: str) -> DataFrame:
    """``df`` with a boolean telling whether the row's key is hot; nulls match nulls."""
    names = hot.columns
    marked = hot.select(*[F.col(n).alias(f"_hot_{n}") for n in names], F.lit(True).alias(flag))
    same = [F.col(n).eqNullSafe(F.col(f"_hot_{n}")) for n in names]
    joined = df.join(F.broadcast(marked), same, "left")
    return joined.withColumn(flag, F.coalesce(flag, F.lit(False))).drop(*[f"_hot_{n}" for n in names])


def same_key(*names: str) -> Column:
    """Null-free text for a key that may be null, so that plain equality joins nulls too.

    Unlike a null-safe join, it keeps the partitioning a window over the same key needs.
    """
    if len(names) > 1:
        return F.to_json(F.struct(*names))
    only = F.col(names[0])
    return F.when(only.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), only.cast("string")))
