"""Counting the rows that break a rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paylake.config import Run
from paylake.functions.calendar import ntz
from paylake.quality.rules import RULES, Rule


class QualityError(RuntimeError):
    """A rule of severity error has failures."""


def _broken(rule: Rule, run: Run) -> Column:
    c = F.col(rule.column)
    if rule.check == "not_null":
        return c.isNull()
    if rule.check == "accepted_values":
        return ~c.isin(*rule.values)
    if rule.check in ("assert_positive", "no_negative"):
        return c < 0
    if rule.check == "no_future":
        return c > ntz(run.run_ts)
    raise ValueError(rule.check)


def _result(rule: Rule, failures: Column) -> Column:
    return F.struct(
        F.lit(rule.relation).alias("relation"), F.lit(rule.column).alias("column_name"),
        F.lit(rule.check).alias("check_name"), F.lit(rule.severity).alias("severity"), failures.alias("failures"),
    )


def _row_rules(df: DataFrame, rules: list[Rule], run: Run) -> DataFrame:
    """All row-wise rules of a relation in one scan that reads just the columns they name."""
    counts = df.agg(*[F.count_if(_broken(r, run)).alias(f"f{i}") for i, r in enumerate(rules)])
    return counts.select(F.explode(F.array(*[_result(r, F.col(f"f{i}")) for i, r in enumerate(rules)])).alias("r")).select("r.*")


def _unique_rule(df: DataFrame, rule: Rule) -> DataFrame:
    """Values seen more than once; nulls do not count."""
    seen = df.where(F.col(rule.column).isNotNull()).groupBy(rule.column).agg(F.count("*").alias("n"))
    return seen.agg(F.count_if(F.col("n") > 1).alias("n")).select(_result(rule, F.col("n")).alias("r")).select("r.*")


def evaluate(relations: dict[str, DataFrame], run: Run, rules: list[Rule] | None = None) -> DataFrame:
    """One row per rule with the number of failures."""
    rules = RULES if rules is None else rules
    parts = []
    for name, df in relations.items():
        mine = [r for r in rules if r.relation == name]
        row_wise = [r for r in mine if r.check != "unique"]
        if row_wise:
            parts.append(_row_rules(df, row_wise, run))
        parts += [_unique_rule(df, r) for r in mine if r.check == "unique"]
    return reduce(DataFrame.unionByName, parts)


def enforce(results: DataFrame) -> None:
    """Raise if a rule of severity error has failures. The result has one row per rule."""
    bad = results.where((F.col("severity") == "error") & (F.col("failures") > 0)).collect()
    if bad:
        raise QualityError("; ".join(f"{r.relation}.{r.column_name} {r.check_name}: {r.failures}" for r in bad))
