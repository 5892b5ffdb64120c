"""Registry of the training-data queries and helpers that several operators use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path, utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, no lineage, true size known to Catalyst."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Narrow rows (ids and hashes) that a broadcast may hold: some tens of MB.
BROADCAST_ROWS = 500_000


def lookup(df: DataFrame) -> DataFrame:
    """A stored table of narrow rows, to be broadcast if it has been counted to be small; else Spark joins by shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
