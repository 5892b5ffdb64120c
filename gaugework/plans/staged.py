"""Boosted trees stopped by average precision on the validation split.

The ensemble is grown by doubling: the first k trees of a longer fit are those of a fit of k trees (each round has
a seed of its own), so one fit gives the scores of all its rounds. The rounds are judged together: a validation row
gives one running margin per round, rows of a round and margin are counted, and the average precision of every round
comes from the same range-partitioned running totals. When no round has been better for ``patience`` rounds, growing
ends; the model returned has the trees of the last fit up to the best round. All fits together cost at most four times
one of the rounds that were judged. The shuffle holds at most (validation rows x rounds) narrow counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import _jvm
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.num import ratio
from ..session import cut
from .model import DEPTH, TREES, boosted, training_rows

PATIENCE = 40  # fixed value: rounds without a better one after which the published model stops
_PREDICT = re.compile(r"Predict: (\S+)")  # leaves in a tree's text, which lists them in the order of their numbers
_STAGED_ROWS = 500_000  # scores that a task holds at once


def average_precision_by(df: DataFrame, group: str, score: str, label: str) -> DataFrame:
    """``group, average_precision``: the step sum over distinct scores within each group, 0 without positives.

    Scores are range-partitioned by group and score, so neither a large group nor a large range is one task.
    Rows with a null group, score or label take no part.
    """
    known = df.where(F.col(group).isNotNull() & F.col(score).isNotNull() & F.col(label).isNotNull())
    counted = known.groupBy(F.col(group).alias("_g"), (-F.col(score).cast("double")).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count(F.lit(1)).alias("_all")
    )
    placed = cut(counted.repartitionByRange("_g", "_s").withColumn("_part", F.spark_partition_id()))
    upto = Window.unboundedPreceding
    inside = Window.partitionBy("_g", "_part").orderBy("_s").rowsBetween(upto, 0)
    before = Window.partitionBy("_g").orderBy("_part").rowsBetween(upto, -1)
    zero = F.lit(0)
    carried = (
        placed.groupBy("_g", "_part")
        .agg(F.sum("_pos").alias("p"), F.sum("_all").alias("a"))
        .select("_g", "_part", *[F.coalesce(F.sum(c).over(before), zero).alias(n) for c, n in (("p", "_p0"), ("a", "_a0"))])
    )
    local = placed.select("_g", "_part", "_pos", F.sum("_pos").over(inside).alias("_tp"), F.sum("_all").over(inside).alias("_alerts"))
    precision = (F.col("_tp") + F.col("_p0")) / (F.col("_alerts") + F.col("_a0"))
    steps = local.join(carried, ["_g", "_part"]).groupBy("_g").agg(F.sum(F.col("_pos") * precision).alias("_steps"), F.sum("_pos").alias("_n"))
    return steps.select(F.col("_g").alias(group), F.coalesce(ratio(F.col("_steps"), F.col("_n")), F.lit(0.0)).alias("average_precision"))


def stopping_curve(curve: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """``round, average_precision, best_round, evaluated, chosen`` of a curve of rounds 1, 2, …

    ``best_round`` is the earliest of the best rounds up to this one. The first round that lies ``patience`` rounds
    after its best round is the last one ``evaluated``; ``chosen`` marks the best round there. A curve has one row
    per round, so its windows are as long as the ensemble.
    """
    upto = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = -F.max(F.struct("average_precision", (-F.col("round")).alias("r"))).over(upto)["r"]
    ran_out = F.col("round") - F.col("best_round") >= patience
    seen = curve.select("round", "average_precision", best.alias("best_round"))
    marked = seen.withColumn("evaluated", ~F.coalesce(F.max(ran_out).over(earlier), F.lit(False)))
    last = F.max(F.when(F.col("evaluated"), F.struct("round", "best_round"))).over(whole)["best_round"]
    return marked.withColumn("chosen", F.col("round") == last)


def staged_scores(df: DataFrame, fitted: PipelineModel, label: str) -> DataFrame:
    """``round, margin, label``: the score of every row after each round of the ensemble.

    One pass over the trees finds the leaf of each; what the leaves add is looked up and summed by the column.
    """
    assembler, ensemble = fitted.stages
    added = [[float(x) * w for x in _PREDICT.findall(t.toDebugString)] for t, w in zip(ensemble.trees, ensemble.treeWeights)]
    table = np.zeros((len(added), max(map(len, added))))
    for i, values in enumerate(added):
        table[i, : len(values)] = values
    rounds, most = np.arange(len(added), dtype="int32"), max(1, _STAGED_ROWS // len(added))

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, most):
                batch = whole.slice(at, most)
                leaves = batch.column("leaves").flatten().to_numpy().reshape(batch.num_rows, len(table)).astype("int64")
                sums = np.cumsum(table[rounds, leaves], axis=1)
                labels = batch.column("label").take(pa.array(np.repeat(np.arange(len(sums)), len(table))))
                yield pa.RecordBatch.from_pydict({"round": np.tile(rounds + 1, len(sums)), "margin": sums.ravel(), "label": labels})

    found = ensemble.copy({ensemble.leafCol: "leaves"}).transform(assembler.transform(df))
    kind = df.schema[label].dataType.simpleString()
    return found.select(vector_to_array("leaves").alias("leaves"), F.col(label).alias("label")).mapInArrow(margins, f"round int, margin double, label {kind}")


def first_trees(fitted: PipelineModel, trees: int) -> PipelineModel:
    """The model of the first rounds: what a fit of so many rounds on the same rows gives."""
    assembler, ensemble = fitted.stages
    java, jvm, array = ensemble._java_obj, _jvm(), JavaWrapper._new_java_array
    kept = array([t._java_obj for t in ensemble.trees[:trees]], jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    weights = array(ensemble.treeWeights[:trees], jvm.double)
    name = "org.apache.spark.ml.classification.GBTClassificationModel"
    shorter = GBTClassificationModel(JavaWrapper._new_java_obj(name, java.uid(), kept, weights, java.numFeatures(), java.numClasses()))
    return PipelineModel([assembler, ensemble._copyValues(shorter)._set(maxIter=trees)])


def fit_stopped(
    data: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH, patience: int = PATIENCE
) -> tuple[PipelineModel, DataFrame]:
    """The model up to its best round, and the curve that chose it. Each split must hold both classes."""
    return grow_stopped(training_rows(data, features, label), features, trees, depth, patience)


def grow_stopped(
    rows: DataFrame, features: Sequence[str], trees: int = TREES, depth: int = DEPTH, patience: int = PATIENCE
) -> tuple[PipelineModel, DataFrame]:
    """The same of rows as ``training_rows`` gives them."""
    train, held = rows.where("NOT held_out"), rows.where("held_out")
    grown = min(trees, patience + max(1, patience // 4))
    while True:
        fitted = boosted(features, grown, depth).fit(train)
        curve = cut(stopping_curve(average_precision_by(staged_scores(held, fitted, "label"), "round", "margin", "label"), patience))
        stop = curve.agg(F.max(F.when(F.col("chosen"), F.col("round"))).alias("best"), F.max(F.when(F.col("evaluated"), F.col("round"))).alias("last")).first()
        if grown == trees or stop.last - stop.best >= patience:
            break
        grown = min(trees, 2 * grown)
    if stop.best < grown:
        fitted = first_trees(fitted, stop.best)
    return fitted, curve.where("evaluated").drop("evaluated")
