"""Newest row per key by aggregation: partial maxima leave each task, never whole groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str], keep: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the highest ``newest_by`` columns, nulls lowest, remaining columns as last resort."""
    keep = [c for c in (keep or df.columns) if c not in keys]
    rest = [c for c in keep if c not in newest_by]
    if not rest and len(newest_by) == 1 and keep == list(newest_by):
        return df.groupBy(*keys).agg(F.max(keep[0]).alias(keep[0]))  # a plain maximum aggregates by hash
    best = F.max(F.struct(*newest_by, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best").getField(c).alias(c) for c in keep])


def latest_with_ties(df: DataFrame, keys: Sequence[str], newest_by: str, payload: Sequence[str]) -> DataFrame:
    """All distinct rows that share the highest ``newest_by`` of their key."""
    rows = df.select(*keys, newest_by, *payload).distinct()
    top = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(newest_by).alias("_top"))
    match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(newest_by) == F.col("_top")]
    return rows.join(top, reduce(lambda a, b: a & b, match), "left_semi")


def latest_conflicts(df: DataFrame, keys: Sequence[str], newest_by: str, payload: Sequence[str]) -> DataFrame:
    """Keys whose newest rows disagree, with the number of versions."""
    tied = latest_with_ties(df, keys, newest_by, payload)
    return tied.groupBy(*keys, newest_by).agg(F.count(F.lit(1)).alias("versions")).where("versions > 1")


def require_no_conflict(df: DataFrame, keys: Sequence[str], newest_by: str, payload: Sequence[str]) -> DataFrame:
    """The newest rows, or an error when a key has several different ones."""
    found = latest_conflicts(df, keys, newest_by, payload).select(*keys).first()
    if found is not None:
        raise ValueError(f"conflicting newest rows, for example {found.asDict()}")
    return latest_with_ties(df, keys, newest_by, payload)
