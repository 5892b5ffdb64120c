"""Outcomes of predictions as they fall due: a time-bounded stream-stream outer join of predictions and failures.

A prediction waits in the join's state until the watermark has passed the longest horizon; it is matched with
failures that arrive before or after it, late ones within the delay included, and goes on without one if there
was none. ``closed`` reads what was written and takes the first failure of each prediction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classes import outcome_class
from ..functions.when import hours, micros
from ..plans.monitoring import with_horizon_end

CARRIED = ["prediction_id", "asset_id", "prediction_time", "horizon_end", "failure_probability", "threshold_used"]


def matches(predictions: DataFrame, failures: DataFrame, longest: str = "168 hours", late: str = "6 hours") -> DataFrame:
    """A row per prediction and failure in ``(prediction_time, horizon_end]``, or one without a failure.

    ``longest`` bounds all horizons; a prediction with a longer one is an error. Equal failures count once.
    """
    ahead = F.col("prediction_time") + F.expr(f"INTERVAL {longest}")
    due = with_horizon_end(predictions)
    within = F.when(F.col("horizon_end") <= ahead, F.col("horizon_end")).otherwise(F.raise_error(F.lit(f"a horizon beyond {longest}")).cast("timestamp"))
    due = due.withColumn("horizon_end", within).select(*CARRIED).withWatermark("prediction_time", late)
    seen = failures.select("machine_id", "failure_time").withWatermark("failure_time", late).dropDuplicatesWithinWatermark(["machine_id", "failure_time"])
    on = (
        (F.col("asset_id") == F.col("machine_id"))
        & (F.col("failure_time") > F.col("prediction_time"))
        & (F.col("failure_time") <= ahead)
        & (F.col("failure_time") <= F.col("horizon_end"))
    )
    return due.join(seen, on, "left_outer").drop("machine_id")


def closed(written: DataFrame, now: Column) -> DataFrame:
    """One outcome per prediction whose horizon has ended at ``now``, an instant that the watermark has passed."""
    first = F.min("failure_time").alias("actual_failure_time")
    rows = written.where(F.col("horizon_end") <= now).groupBy(*CARRIED).agg(first)
    happened = F.col("actual_failure_time").isNotNull()
    return rows.select(
        "prediction_id",
        "horizon_end",
        happened.alias("failure_observed"),
        F.when(happened, F.col("asset_id")).alias("actual_machine_id"),
        "actual_failure_time",
        hours(micros("actual_failure_time") - micros("prediction_time")).alias("lead_time_hours"),
        outcome_class(F.col("failure_probability") >= F.col("threshold_used"), happened).alias("outcome_class"),
    )
