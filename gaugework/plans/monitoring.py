"""Evaluation of stored predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classes import outcome_class
from ..functions.num import ratio
from ..functions.when import hours, instant, micros
from ..operators.latest import latest_per_key
from ..operators.temporal import first_after

HOUR_US = 3_600_000_000


def with_horizon_end(predictions: DataFrame, anchor: str = "prediction_time") -> DataFrame:
    kind = predictions.schema[anchor].dataType.simpleString()
    return predictions.withColumn("horizon_end", instant(micros(anchor) + F.col("forecast_horizon_hours") * F.lit(HOUR_US), kind))


def mature(predictions: DataFrame, evaluated: DataFrame, now: Column) -> DataFrame:
    """Predictions whose horizon has closed and that have no outcome yet."""
    due = with_horizon_end(predictions).where(micros("horizon_end") <= micros(now))
    return due.join(evaluated.select("prediction_id"), "prediction_id", "left_anti")


def outcomes(due: DataFrame, failures: DataFrame) -> DataFrame:
    """First failure in ``(prediction_time, horizon_end]`` and the class at the stored threshold."""
    seen = first_after(
        due, failures, [("asset_id", "machine_id")], "prediction_time", "failure_time", horizon_end="horizon_end", name="actual_failure_time"
    )
    happened = F.col("actual_failure_time").isNotNull()
    return seen.select(
        "prediction_id",
        "horizon_end",
        happened.alias("failure_observed"),
        F.when(happened, F.col("asset_id")).alias("actual_machine_id"),
        "actual_failure_time",
        hours(micros("actual_failure_time") - micros("prediction_time")).alias("lead_time_hours"),
        outcome_class(F.col("failure_probability") >= F.col("threshold_used"), happened).alias("outcome_class"),
    )


def outcome_summary(rows: DataFrame) -> DataFrame:
    def n(name: str) -> Column:
        return F.count_if(F.col("outcome_class") == name)

    c = rows.agg(
        F.count(F.lit(1)).alias("evaluated"),
        n("true_positive").alias("tp"),
        n("false_positive").alias("fp"),
        n("false_negative").alias("fn"),
        n("true_negative").alias("tn"),
        F.avg(F.when(F.col("outcome_class") == "true_positive", F.col("lead_time_hours"))).alias("mean_lead_hours"),
    )
    return c.withColumns(
        {"precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))}
    )


def calibration(predictions: DataFrame, rows: DataFrame, by: Sequence[str] = ("risk_level",)) -> DataFrame:
    both = predictions.join(rows.select("prediction_id", "failure_observed"), "prediction_id")
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("evaluated_predictions"),
        F.count_if("failure_observed").alias("observed_failures"),
        F.avg("failure_probability").alias("mean_predicted_probability"),
        F.avg(F.col("failure_observed").cast("double")).alias("observed_failure_rate"),
    )


def eligible_latest(predictions: DataFrame, as_of: Column, context: dict) -> DataFrame:
    """Latest available prediction per asset within one model, version and horizon, with its freshness."""
    scored = F.coalesce("scored_at", "prediction_time")
    asked = micros(as_of)
    scoped = predictions
    for column, value in context.items():
        scoped = scoped.where(F.col(column) == F.lit(value))
    ready = scoped.where((micros("feature_time") <= asked) & (micros("prediction_time") <= asked) & (micros(scored) <= asked))
    newest = latest_per_key(ready.withColumn("_scored", scored), ["asset_id"], ["feature_time", "_scored", "prediction_time", "prediction_id"])
    end = micros("feature_time") + F.col("forecast_horizon_hours") * F.lit(HOUR_US)
    return newest.drop("_scored").withColumn("fresh", asked < end)
