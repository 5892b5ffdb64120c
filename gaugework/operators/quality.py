"""Checks that report violations as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows with a null in any key column."""
    broken = F.lit(False)
    for k in keys:
        broken = broken | F.col(k).isNull()
    return df.agg(F.count_if(broken).alias("null_key_rows"), F.count(F.lit(1)).alias("row_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "row_count") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Distinct non-null child keys without a parent, with their row counts."""
    used = child.where(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(parent.select(F.col(parent_key).alias("_pk")), F.col(child_key) == F.col("_pk"), "left_anti")


def rule_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``rule, violations`` for row rules, all counted in one pass; a null condition is a violation."""
    counts = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"r{i}") for i, ok in enumerate(rules.values())])
    rows = [F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("violations")) for i, n in enumerate(rules)]
    return counts.select(F.inline(F.array(*rows)))


def preflight(df: DataFrame, keys: Sequence[str], name: str = "table") -> None:
    """Raise when a logical key has nulls or duplicates."""
    if null_keys(df, keys).first()["null_key_rows"]:
        raise ValueError(f"null logical key in {name}")
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate logical key in {name}")


def version_issues(df: DataFrame, business_key: str, current: str) -> DataFrame:
    """Business keys that do not have exactly one current version."""
    n = df.groupBy(business_key).agg(F.count_if(F.col(current)).alias("current_rows"), F.count(F.lit(1)).alias("versions"))
    return n.where("current_rows <> 1")


def share_sums(df: DataFrame, keys: Sequence[str], share: str, tolerance: float = 1e-9) -> DataFrame:
    """Groups whose shares do not add up to 1."""
    total = df.groupBy(*keys).agg(F.sum(share).alias("share_sum"))
    return total.where(F.abs(F.col("share_sum") - 1) > tolerance)
