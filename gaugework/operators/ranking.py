"""Threshold choice and ranking metrics over scored rows.

Scores are first reduced to one row per distinct value. The running totals then go over score
ranges: a window per range, plus one carried row per range, so no task sees all scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.num import ratio
from ..session import cut

DEFAULT_THRESHOLD = 0.65  # fixed value used when there is nothing to choose from


def score_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: ``pos, neg`` at the score and cumulative ``tp, fp`` at or above it.

    Distinct scores are range-partitioned, as many ranges as the session has shuffle partitions; the ranges
    are cut with a checkpoint, so that their limits are the same wherever they are read.
    """
    per_score = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    placed = cut(per_score.repartitionByRange("score").withColumn("_part", F.spark_partition_id()))
    upto = Window.unboundedPreceding
    inside = Window.partitionBy("_part").orderBy(F.col("score").desc()).rowsBetween(upto, 0)
    above = Window.orderBy(F.col("_part").desc()).rowsBetween(upto, -1)
    carried = (
        placed.groupBy("_part")
        .agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
        .select(F.col("_part").alias("_cpart"), F.sum("_p").over(above).alias("_p"), F.sum("_n").over(above).alias("_n"))
    )
    local = placed.withColumns({"tp": F.sum("pos").over(inside), "fp": F.sum("neg").over(inside)})
    zero = F.lit(0)
    return local.join(carried, F.col("_part") == F.col("_cpart"), "left").select(
        "score",
        "pos",
        "neg",
        (F.col("tp") + F.coalesce("_p", zero)).alias("tp"),
        (F.col("fp") + F.coalesce("_n", zero)).alias("fp"),
    )


def threshold_by_f1(df: DataFrame, score: str, label: str, default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """``threshold, f1``: the score with the best F1 when alerting at or above it; lowest on ties."""
    curve = score_curve(df, score, label)
    positives = curve.agg(F.sum("pos").alias("p")).scalar()
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    recall = F.coalesce(ratio(F.col("tp"), positives), F.lit(1.0))
    f1 = 2 * precision * recall / F.greatest(precision + recall, F.lit(1e-12))
    best = curve.select(f1.alias("f1"), "score").agg(F.max(F.struct("f1", (-F.col("score")).alias("neg"))).alias("b"))
    return best.select(F.coalesce(-F.col("b.neg"), F.lit(default)).alias("threshold"), F.col("b.f1").alias("f1"))


def ranking_metrics(df: DataFrame, score: str, label: str) -> DataFrame:
    """``positives, negatives, roc_auc, average_precision`` in one row.

    AUC is the rank-sum form (tied pairs count half). Average precision is the step sum over
    distinct thresholds, without interpolation.
    """
    curve = score_curve(df, score, label)
    below = F.col("neg") / 2 - F.col("fp")
    sums = curve.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(F.col("pos") * below).alias("_pairs"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("_steps"),
    )
    p, n = F.col("positives"), F.col("negatives")
    return sums.select(
        p.cast("long").alias("positives"),
        n.cast("long").alias("negatives"),
        ratio(F.col("_pairs") + p * n, p * n).alias("roc_auc"),
        ratio(F.col("_steps"), p).alias("average_precision"),
    )


def alert_metrics(df: DataFrame, score: str, label: str, threshold) -> DataFrame:
    """Confusion counts, precision, recall (0 where undefined) and Brier score at a threshold."""
    alerted, real = F.col(score) >= threshold, F.col(label) == 1
    counts = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).agg(
        F.count_if(alerted & real).alias("tp"),
        F.count_if(alerted & ~real).alias("fp"),
        F.count_if(~alerted & real).alias("fn"),
        F.count_if(~alerted & ~real).alias("tn"),
        F.avg((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("brier_score"),
    )
    zero = F.lit(0.0)
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fp")), zero).alias("precision"),
        F.coalesce(ratio(F.col("tp"), F.col("tp") + F.col("fn")), zero).alias("recall"),
        "brier_score",
    )
