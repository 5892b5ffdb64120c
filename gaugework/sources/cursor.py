"""Incremental reads with an overlap for late arrivals."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from ..functions.when import span


def incremental_slice(
    df: DataFrame,
    ts: str,
    key: str,
    seen: DataFrame,
    last_ts: datetime | None,
    now: datetime,
    overlap: str = "6 hours",
    backfill: str = "30 days",
) -> DataFrame:
    """Rows since the cursor minus the overlap whose key has not been seen.

    Without a cursor the read starts one backfill before ``now``. The lower bound is a literal, so
    it reaches the scan. Keys in the overlap that were already taken are removed by anti join.
    """
    start = last_ts - timedelta(microseconds=span(overlap)) if last_ts else now - timedelta(microseconds=span(backfill))
    kind = df.schema[ts].dataType.simpleString()
    lower, upper = F.lit(start).cast(kind), F.lit(now).cast(kind)
    recent = df.where((F.col(ts) >= lower) & (F.col(ts) <= upper))
    return recent.join(seen.select(F.col(key).alias("_seen")), F.col(key) == F.col("_seen"), "left_anti")


def next_cursor(taken: DataFrame, ts: str) -> DataFrame:
    """The new cursor: the highest instant taken, null when nothing was."""
    return taken.agg(F.max(ts).alias("cursor"), F.count(F.lit(1)).alias("taken"))


def fetch_chunks(start: datetime, end: datetime, width: str = "30 days") -> list[tuple[datetime, datetime]]:
    """Consecutive ranges of at most ``width`` that cover ``[start, end)``."""
    step, out = timedelta(microseconds=span(width)), []
    while start < end:
        out.append((start, min(start + step, end)))
        start += step
    return out
