"""Tumbling-window features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.when import instant, micros, span, whole

P95_ACCURACY = 10_000  # fixed value of the published feature


@dataclass(frozen=True)
class Metric:
    """Statistics of one measured column: mean, stddev, min, max, p95, slope, spike_count."""

    name: str
    column: str
    stats: tuple[str, ...] = ("mean", "stddev", "min", "max", "p95", "slope", "spike_count")
    spike_above: float = 0.0


def metric_aggregates(metric: Metric, order: Column, window_hours: float) -> dict[str, Column]:
    """Aggregate expressions of a metric; ``order`` ranks the rows of a window without ties."""
    x = F.col(metric.column)
    known = {
        "mean": F.avg(x),
        "stddev": F.stddev_samp(x),
        "min": F.min(x),
        "max": F.max(x),
        "p95": F.percentile_approx(x, 0.95, P95_ACCURACY),
        "slope": (F.max_by(x, order) - F.min_by(x, order)) / F.lit(window_hours),
        "spike_count": F.count_if(x > F.lit(metric.spike_above)),
    }
    return {f"{metric.name}_{s}": known[s] for s in metric.stats}


def tumbling_features(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    metrics: Sequence[Metric],
    width: str = "24 hours",
    tie: Sequence[str] = (),
    latest: Sequence[str] = (),
    count_name: str = "telemetry_count",
) -> DataFrame:
    """One row per key and epoch-aligned window that has rows.

    All statistics have partial aggregates, so a hot key is reduced before the shuffle.
    ``latest`` columns take the value of the last row of the window.
    """
    w = span(width)
    kind = df.schema[ts].dataType.simpleString()
    order = F.struct(micros(ts), *tie)
    aggs: dict[str, Column] = {count_name: F.count(F.lit(1))}
    for m in metrics:
        aggs.update(metric_aggregates(m, order, w / 3_600_000_000))
    for c in latest:
        aggs[c] = F.max_by(c, order)
    known = [F.col(c).isNotNull() for c in (*keys, ts)]
    rows = df
    for cond in known:
        rows = rows.where(cond)
    grouped = rows.groupBy(*keys, whole(micros(ts), w).alias("_w")).agg(*[c.alias(n) for n, c in aggs.items()])
    return grouped.select(
        *keys,
        instant(F.col("_w") * w, kind).alias("window_start"),
        instant((F.col("_w") + 1) * w, kind).alias("window_end"),
        *aggs,
    )


# The window before a failure in seconds, the load surge and how often it comes.
DEGRADATION_SECONDS, SURGE, SURGE_EVERY = 259_200, 15.0, 3


def degradation(seconds_to_failure: Column, sequence: Column) -> dict[str, Column]:
    """``degradation``: how far the window before the next failure has passed, 0 without a failure ahead; ``surge`` of every third row."""
    passed = F.coalesce(1.0 - seconds_to_failure / DEGRADATION_SECONDS, F.lit(0.0))
    surges = (passed > 0) & (sequence % SURGE_EVERY == 0)
    return {"degradation": passed, "surge": F.when(surges, passed * SURGE).otherwise(0.0)}
