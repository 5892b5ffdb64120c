"""Ratios, shares and changes over grouped data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.num import ratio


def ratio_of_sums(df: DataFrame, by: Sequence[str], num: Column, den: Column, name: str = "ratio") -> DataFrame:
    """Sums first, then one division per group; null where the denominator sums to zero."""
    sums = df.groupBy(*by).agg(F.sum(num).alias("numerator"), F.sum(den).alias("denominator"))
    return sums.withColumn(name, ratio("numerator", "denominator"))


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Each row's part of the total; the total is a scalar subquery, not a one-task window."""
    total = df.agg(F.sum(value).alias("t")).scalar()
    return df.withColumn(name, ratio(F.col(value), total))


def change_from_previous(df: DataFrame, keys: Sequence[str], step: str, value: str) -> DataFrame:
    """Previous value and relative change along an integer step such as a year.

    For data already reduced to one row per key and step. A missing step is not bridged.
    """
    w = Window.partitionBy(*keys).orderBy(step).rangeBetween(-1, -1)
    previous = F.max(value).over(w)
    return df.withColumn(f"previous_{value}", previous).withColumn(
        f"{value}_change", ratio(F.col(value) - F.col(f"previous_{value}"), F.col(f"previous_{value}"))
    )


def top_k(df: DataFrame, k: int, by: Sequence[tuple[str, bool]]) -> DataFrame:
    """The k first rows with their rank; ``by`` lists (column, descending) and decides every tie."""
    order = [F.col(c).desc() if down else F.col(c).asc() for c, down in by]
    best = df.orderBy(*order).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def capped_per_group(df: DataFrame, group: str, limits: Mapping[str, int], order: Column) -> DataFrame:
    """The first ``limits[g]`` rows of each group by a pseudo-random order: a reproducible sample.

    A cut-off per group comes from a histogram of the first four hex digits of ``order``; only the rows
    of the bucket where the limit is reached are ranked, 1/65536 of the group on average.
    """
    tagged = df.withColumns({"_o": order, "_b": F.substring(order, 1, 4)})
    hist = tagged.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(
        F.sum("_n").over(Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    limit = F.lit(0)
    for g, n in limits.items():
        limit = F.when(F.col(group) == g, F.lit(n)).otherwise(limit)
    room = hist.select(F.col(group).alias("_g"), F.col("_b").alias("_gb"), (limit - before).alias("_room"), "_n").where("_room > 0")
    open_rows = tagged.join(room, (F.col(group) == F.col("_g")) & (F.col("_b") == F.col("_gb")))
    whole = open_rows.where("_n <= _room")
    rank = F.row_number().over(Window.partitionBy(group, "_b").orderBy("_o"))
    edge = open_rows.where("_n > _room").withColumn("_rank", rank).where("_rank <= _room").drop("_rank")
    return whole.unionByName(edge).select(*df.columns)
