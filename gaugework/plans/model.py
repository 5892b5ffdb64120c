"""Failure classifier on Spark ML: fit, score, serve and check. No row leaves the executors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classes import ACTIONS, RISK_LEVELS, recommended_action, risk_level
from ..functions.num import finite_or_zero
from ..operators.latest import latest_per_key
from ..operators.ranking import alert_metrics, ranking_metrics, threshold_by_f1
from ..session import scratch_path
from .snapshots import require_trainable

# Settings of the published model that Spark ML also has.
LEARNING_RATE, SUBSAMPLE, SEED = 0.05, 0.8, 42
TREES, DEPTH, ROWS_PER_LEAF, FEATURES_PER_SPLIT = 600, 8, 5, "0.8"


def clean(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Null and non-finite features become 0."""
    return df.withColumns({f: finite_or_zero(f) for f in features})


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """``n, positives, positive_weight``: negatives per positive."""
    n, p = F.count(F.lit(1)), F.count_if(F.col(label) == 1)
    return df.where(F.col(label).isNotNull()).agg(
        n.alias("n"), p.alias("positives"), ((n - p) / F.greatest(F.lit(1), p)).alias("positive_weight")
    )


def labelled_rows(data: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``features, label, dataset_split`` of the labelled rows; each split must hold both classes.

    The rows are written once to the shared folder: the check, the fit and the evaluation read them
    again instead of building the snapshots, and a written table survives the loss of executors.
    """
    spark = data.sparkSession
    path = scratch_path(spark, "training")
    rows = clean(data, features).where(F.col(label).isNotNull())
    rows.select(*features, F.col(label).cast("double").alias("label"), "dataset_split").write.parquet(path)
    stored = spark.read.parquet(path)
    require_trainable(stored, "label")
    return stored


def weighted_rows(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``features, label, held_out, weight`` of the train and validation splits of ``labelled_rows``."""
    both = rows.where(F.col("dataset_split").isin("train", "validation"))
    both = both.select(*features, "label", (F.col("dataset_split") == "validation").alias("held_out"))
    weight = class_weight(both.where("NOT held_out"), "label").select("positive_weight").scalar()
    return both.withColumn("weight", F.when(F.col("label") == 1, weight).otherwise(1.0))


def training_rows(data: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``features, label, held_out, weight`` of the train and validation splits, which must hold both classes."""
    return weighted_rows(labelled_rows(data, features, label), features)


def boosted(features: Sequence[str], trees: int, depth: int, **more) -> Pipeline:
    """Boosted trees over the rows of ``training_rows``."""
    ensemble = GBTClassifier(
        featuresCol="vector",
        labelCol="label",
        weightCol="weight",
        maxIter=trees,
        maxDepth=depth,
        stepSize=LEARNING_RATE,
        subsamplingRate=SUBSAMPLE,
        minInstancesPerNode=ROWS_PER_LEAF,
        featureSubsetStrategy=FEATURES_PER_SPLIT,
        seed=SEED,
        **more,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="vector"), ensemble])


def fit_classifier(data: DataFrame, features: Sequence[str], label: str, trees: int = TREES, depth: int = DEPTH) -> PipelineModel:
    """Boosted trees on the train split, stopped early by the loss on the validation split."""
    return boosted(features, trees, depth, validationIndicatorCol="held_out").fit(training_rows(data, features, label))


def score(df: DataFrame, fitted: PipelineModel, features: Sequence[str]) -> DataFrame:
    out = fitted.transform(clean(df, features))
    return out.withColumn("failure_probability", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def score_latest(df: DataFrame, fitted: PipelineModel, features: Sequence[str]) -> DataFrame:
    newest = latest_per_key(df, ["asset_id"], ["feature_time"], ["feature_time", *[f for f in features if f != "asset_id"]])
    return score(newest, fitted, features)


def linear_score(df: DataFrame, weights: Mapping[str, float], bias: float) -> DataFrame:
    """Logistic score as one expression over a fixed order of features."""
    z: Column = F.lit(bias)
    for f, w in weights.items():
        z = z + finite_or_zero(f) * F.lit(w)
    return df.withColumn("failure_probability", 1 / (1 + F.exp(-z)))


def evaluate(data: DataFrame, fitted: PipelineModel, features: Sequence[str], label: str) -> DataFrame:
    """Threshold from the validation split, metrics on the test split, one row."""
    # score columns are written once: the threshold and three metric passes read them
    judged = data.where(F.col(label).isNotNull() & F.col("dataset_split").isin("validation", "test"))
    scored = score(judged, fitted, features).select("dataset_split", "failure_probability", label)
    path = scratch_path(data.sparkSession, "scores")
    scored.write.parquet(path)
    stored = data.sparkSession.read.parquet(path)
    chosen = threshold_by_f1(stored.where("dataset_split = 'validation'"), "failure_probability", label)
    test = stored.where("dataset_split = 'test'")
    limit = chosen.select("threshold").scalar()
    ranked = ranking_metrics(test, "failure_probability", label)
    alerts = alert_metrics(test, "failure_probability", label, limit)
    return alerts.withColumns({c: ranked.select(c).scalar() for c in ("roc_auc", "average_precision")}).withColumn("alert_threshold", limit)


def serve(df: DataFrame, threshold: Column, prob: str = "failure_probability") -> DataFrame:
    """The response contract: probability, prediction, risk, action and the threshold used."""
    p = F.col(prob)
    return df.withColumns(
        {
            "predicted_failure": (p >= threshold).cast("int"),
            "risk_level": risk_level(p, threshold),
            "recommended_action": recommended_action(p, threshold),
            "threshold_used": threshold,
        }
    )


def response_rules() -> dict[str, Column]:
    p, t = F.col("failure_probability"), F.col("threshold_used")
    return {
        "probability_in_range": p.between(0.0, 1.0) & ~F.isnan(p),
        "threshold_in_range": t.between(0.0, 1.0) & ~F.isnan(t),
        "prediction_consistent": F.col("predicted_failure") == (p >= t).cast("int"),
        "known_risk_level": F.col("risk_level").isin(*RISK_LEVELS),
        "action_present": F.col("recommended_action").isin(*ACTIONS),
    }


def smoke_check(df: DataFrame, prob: str) -> DataFrame:
    p = F.col(prob)
    ok = F.coalesce(p.between(0.0, 1.0) & ~F.isnan(p), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("row_count"), (F.count_if(ok) == F.count(F.lit(1))).alias("valid"))


def with_prediction_id(df: DataFrame, run: str, keys: Sequence[str] = ("asset_id", "feature_time")) -> DataFrame:
    return df.withColumn("prediction_id", F.xxhash64(*keys, F.lit(run)))
