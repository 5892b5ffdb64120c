"""Isotonic calibration: pooled adjacent violators over score ranges.

Scores are reduced to one row per distinct value and cut into ranges of bounded size. Each range is pooled in
a task of its own. Ranges are then joined in pairs, pairs of pairs and so on: what two neighbours pool is a
tail of the left and a head of the right one, and its mean m is the root of

    sum over left rows with mean > m of (positives - m rows) + the same over right rows with mean < m,

which decreases in m. All pairs of a level look for their roots together, with one aggregate of the stored rows
a step; only two bounds a pair are on the driver. A step goes to the mean of what lies beyond m (exact once
that set stays) or, every other time, to the middle of the bounds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut

#: Distinct scores of a range, which one task pools.
RANGE_ROWS = 500_000


def pooled(pos: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Means after pooling adjacent violators; ``pos`` of ``n`` rows each, in order of the score."""
    sums, rows, sizes = [], [], []
    for p, k in zip(pos.tolist(), n.tolist(), strict=True):
        size = 1
        while sums and sums[-1] * k >= p * rows[-1]:
            p, k, size = p + sums.pop(), k + rows.pop(), size + sizes.pop()
        sums.append(p)
        rows.append(k)
        sizes.append(size)
    return np.repeat(np.array(sums, dtype=float) / np.array(rows, dtype=float), sizes)


def isotonic_curve(df: DataFrame, score: str, label: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``score, pos, n, fitted`` for every distinct score: the non-decreasing rates nearest to the observed ones.

    Rows without a score or a label (0 or 1) are left out; no rows give no curve.
    """
    known = df.where(F.col(score).isNotNull() & F.col(label).isin(0, 1))
    per_score = cut(known.groupBy(F.col(score).cast("double").alias("score")).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count(F.lit(1)).alias("n")))
    ranges = max(1, math.ceil(per_score.count() / range_rows))
    placed = per_score.repartitionByRange(ranges, "score").withColumn("part", F.spark_partition_id())

    def run(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [*groups]
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True).sort_values("score")
        yield rows.assign(mean=pooled(rows["pos"].to_numpy(), rows["n"].to_numpy()))

    fitted = cut(placed.mapInPandas(run, "score double, pos long, n long, part int, mean double"))
    level = 0
    while ranges > 1 << level:
        fitted = cut(_joined(fitted, level))
        level += 1
    return fitted.select("score", "pos", "n", F.col("mean").alias("fitted"))


def calibrated(df: DataFrame, score: str, curve: DataFrame, name: str = "calibrated") -> DataFrame:
    """``df`` with the fitted rate of each row's score; null without a score. ``curve`` must come from the scores of ``df``."""
    fitted = curve.select(F.col("score").alias("_score"), F.col("fitted").alias(name))
    return df.join(fitted, F.col(score).cast("double") == F.col("_score"), "left").drop("_score")


def _joined(rows: DataFrame, level: int) -> DataFrame:
    """``rows`` with the pairs of neighbours of this level pooled."""
    sided = rows.withColumns({"pair": F.shiftright("part", level + 1), "left": F.shiftright("part", level) % 2 == 0})
    edges = sided.groupBy("pair").agg(F.max(F.when(F.col("left"), F.col("mean"))).alias("top"), F.min(F.when(~F.col("left"), F.col("mean"))).alias("low"))
    bounds = {r["pair"]: (r["low"], r["top"]) for r in edges.where("top > low").collect()}
    tried, found, step = {pair: (low + top) / 2 for pair, (low, top) in bounds.items()}, {}, 0
    while tried:
        step += 1
        beyond = _with_mean(sided, tried, "inner").where(_pools()).groupBy("pair").agg((F.sum("pos") / F.sum("n")).alias("mean"))
        for pair, mean in beyond.collect():
            m, (low, top) = tried[pair], bounds[pair]
            bounds[pair] = low, top = (m, top) if mean > m else (low, m)
            after = mean if step % 2 and low < mean < top else (low + top) / 2
            if mean == m or after == m:  # the root, or no number between the bounds
                found[pair] = tried.pop(pair)
            else:
                tried[pair] = after
    if not found:
        return rows
    return _with_mean(sided, found, "left").withColumn("mean", F.when(_pools(), F.col("m")).otherwise(F.col("mean"))).select(*rows.columns)


def _with_mean(rows: DataFrame, means: dict[int, float], how: str) -> DataFrame:
    """``rows`` with the m of their pair: one row a pair of ranges is broadcast."""
    listed = rows.sparkSession.createDataFrame(list(means.items()), "pair int, m double")
    return rows.join(F.broadcast(listed), "pair", how)


def _pools():
    return F.when(F.col("left"), F.col("mean") > F.col("m")).otherwise(F.col("mean") < F.col("m"))
