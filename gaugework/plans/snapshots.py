"""Point-in-time feature snapshots with forward-looking labels.

Snapshots sit on the window grid: a feature time is the end of a window. The history and the
horizon are whole multiples of the window, so every point-in-time question about a snapshot can
be answered from per-(asset, window) aggregates. All sources are therefore reduced to that grain
in one pass with map-side combine, and the point-in-time parts are RANGE frames over at most one
row per window and asset. Raw rows are never sorted, paired or collected per asset.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.when import hours, instant, micros, span, whole
from ..operators.features import Metric, metric_aggregates, tumbling_features
from ..operators.temporal import as_of_latest, count_in_window, first_after

# The published windows, split shares and measures.
WINDOW, HORIZON, HISTORY = "24 hours", "168 hours", "90 days"
TRAIN_SHARE, VALIDATION_SHARE = 0.70, 0.85
METRICS = (
    Metric("temperature", "temperature", ("mean", "stddev", "min", "max", "slope", "spike_count"), 70.0),
    Metric("cpu", "cpu_load", ("mean", "p95", "max", "spike_count"), 90.0),
    Metric("latency", "network_latency", ("mean", "p95", "max", "spike_count"), 150.0),
)
FEATURES = (
    "telemetry_count",
    "temperature_mean",
    "temperature_stddev",
    "temperature_min",
    "temperature_max",
    "temperature_slope",
    "cpu_mean",
    "cpu_p95",
    "cpu_max",
    "latency_mean",
    "latency_p95",
    "latency_max",
    "temperature_spike_count",
    "cpu_spike_count",
    "latency_spike_count",
    "operating_hours",
    "hours_since_maintenance",
    "failures_last_90d",
    "asset_type_id",
    "asset_model_id",
    "hardware_configuration_id",
)
LABEL, LABEL_TIME = "label_failure_within_horizon", "label_failure_time"


@dataclass(frozen=True)
class FleetInputs:
    """Sources with the columns the snapshot reads.

    telemetry: asset_id, event_time, the metric columns, hardware_configuration_id and a tie
    column; failures: asset_id, failure_time; meters: asset_id, reading_time, meter_reading_id,
    operating_hours; maintenance: asset_id, completed_at; assets: asset_id, asset_type_id,
    asset_model_id.
    """

    telemetry: DataFrame
    failures: DataFrame
    meters: DataFrame
    maintenance: DataFrame
    assets: DataFrame
    metrics: Sequence[Metric] = METRICS
    tie: str = "event_id"


@dataclass(frozen=True)
class Spans:
    window: str = WINDOW
    horizon: str = HORIZON
    history: str = HISTORY

    def steps(self) -> tuple[int, int, int]:
        w, h, b = span(self.window), span(self.horizon), span(self.history)
        if h % w or b % w:
            raise ValueError("horizon and history must be whole multiples of the window")
        return w, h // w, b // w


def _known(df: DataFrame, ts: str) -> DataFrame:
    return df.where(F.col("asset_id").isNotNull() & F.col(ts).isNotNull())


def snapshot_features(src: FleetInputs, spans: Spans = Spans()) -> DataFrame:
    """One row per asset and window with telemetry: features, next failure within the horizon."""
    width, ahead, behind = spans.steps()
    kind = src.telemetry.schema["event_time"].dataType.simpleString()

    def after(us):  # the first grid point strictly after the instant
        return whole(us, width) + 1

    def at_or_after(us):
        return -whole(-us, width)

    measured = list(dict.fromkeys(m.column for m in src.metrics))
    t_us = micros("event_time")
    telemetry = _known(src.telemetry, "event_time").select(
        "asset_id",
        after(t_us).alias("_g"),
        F.struct(t_us.alias("us"), F.col(src.tie).alias("tie")).alias("_t"),
        *measured,
        "hardware_configuration_id",
    )
    failed = _known(src.failures, "failure_time").select("asset_id", micros("failure_time").alias("us")).distinct()
    history = failed.select("asset_id", after(F.col("us")).alias("_g"), F.lit(1).cast("long").alias("_f"))
    coming = failed.select("asset_id", at_or_after(F.col("us")).alias("_g"), F.col("us").alias("_n"))
    m_us = micros("reading_time")
    meters = _known(src.meters, "reading_time").select(
        "asset_id",
        at_or_after(m_us).alias("_g"),
        F.struct(m_us.alias("us"), F.col("meter_reading_id").alias("id"), F.col("operating_hours").alias("v")).alias("_m"),
    )
    upkeep = _known(src.maintenance, "completed_at").select(
        "asset_id", at_or_after(micros("completed_at")).alias("_g"), micros("completed_at").alias("_o")
    )
    everything = telemetry
    for part in (history, coming, meters, upkeep):
        everything = everything.unionByName(part, allowMissingColumns=True)

    aggs = {"telemetry_count": F.count("_t")}
    for m in src.metrics:
        aggs.update(metric_aggregates(m, F.col("_t"), width / 3_600_000_000))
    aggs["hardware_configuration_id"] = F.max_by("hardware_configuration_id", "_t")
    aggs.update({"_m": F.max("_m"), "_o": F.max("_o"), "_f": F.sum("_f"), "_n": F.min("_n")})
    grid = everything.groupBy("asset_id", "_g").agg(*[c.alias(n) for n, c in aggs.items()])

    line = Window.partitionBy("asset_id").orderBy("_g")
    so_far = line.rangeBetween(Window.unboundedPreceding, 0)
    timed = grid.withColumns(
        {
            "_m": F.max("_m").over(so_far),
            "_o": F.max("_o").over(so_far),
            "_f": F.sum("_f").over(line.rangeBetween(1 - behind, 0)),
            "_n": F.min("_n").over(line.rangeBetween(1, ahead)),
        }
    ).where("telemetry_count > 0")
    point = F.col("_g") * F.lit(width)
    stats = [n for n in aggs if not n.startswith("_")]
    return timed.select(
        "asset_id",
        instant(point, kind).alias("feature_time"),
        instant(point - F.lit(width), kind).alias("window_start"),
        instant(point, kind).alias("window_end"),
        *stats,
        F.col("_m.v").alias("operating_hours"),
        hours(point - F.col("_o")).alias("hours_since_maintenance"),
        F.coalesce("_f", F.lit(0)).alias("failures_last_90d"),
        instant(F.col("_n"), kind).alias(LABEL_TIME),
    ).join(src.assets.select("asset_id", "asset_type_id", "asset_model_id"), "asset_id", "left")


def snapshot_features_by_scan(src: FleetInputs, spans: Spans = Spans()) -> DataFrame:
    """The same rows from the general operators, for spans that are off the window grid."""
    base = tumbling_features(
        src.telemetry, ["asset_id"], "event_time", src.metrics, spans.window, [src.tie], ["hardware_configuration_id"]
    ).withColumn("feature_time", F.col("window_end"))
    failed = src.failures.select("asset_id", "failure_time").distinct()
    done = src.maintenance
    out = as_of_latest(
        base, src.meters, "asset_id", "feature_time", "reading_time", ["operating_hours"], tie=["meter_reading_id"]
    )
    out = as_of_latest(out, done, "asset_id", "feature_time", "completed_at", matched="_done")
    out = out.withColumn("hours_since_maintenance", hours(micros("feature_time") - micros("_done"))).drop("_done")
    out = count_in_window(out, failed, "asset_id", "feature_time", "failure_time", spans.history, "failures_last_90d")
    out = first_after(out, failed, "asset_id", "feature_time", "failure_time", spans.horizon, name=LABEL_TIME)
    return out.join(src.assets.select("asset_id", "asset_type_id", "asset_model_id"), "asset_id", "left")


def data_cutoff(telemetry: DataFrame, failures: DataFrame) -> DataFrame:
    """Latest instant of either source, one row."""
    tops = telemetry.agg(F.max("event_time").alias("t")).unionByName(failures.agg(F.max("failure_time").alias("t")))
    return tops.agg(F.max("t").alias("data_cutoff"))


def label_with_horizon(df: DataFrame, cutoff: DataFrame, horizon: str = HORIZON, ts: str = "feature_time") -> DataFrame:
    """1 or 0 once the horizon has closed within the data, null while it is open."""
    closed = micros(ts) <= micros(cutoff.scalar()) - F.lit(span(horizon))
    return df.withColumn(LABEL, F.when(closed, F.col(LABEL_TIME).isNotNull().cast("int")))


def label_bounds(df: DataFrame, ts: str = "feature_time", label: str = LABEL) -> DataFrame:
    """First and last labelled second and the number of labelled rows, one row."""
    labelled = df.where(F.col(label).isNotNull())
    sec = F.unix_seconds(F.col(ts).cast("timestamp"))
    return labelled.agg(F.min(sec).alias("lo"), F.max(sec).alias("hi"), F.count(F.lit(1)).alias("labelled"))


def grid_label_bounds(telemetry: DataFrame, cutoff: DataFrame, spans: Spans = Spans()) -> DataFrame:
    """The same bounds from one column of the telemetry, without building the snapshots."""
    width = span(spans.window)
    point = (whole(micros("event_time"), width) + 1) * F.lit(width)
    closed = micros(cutoff.scalar()) - F.lit(span(spans.horizon))
    sec = (F.col("p") / F.lit(1_000_000)).cast("long")
    return telemetry.select(point.alias("p")).where(F.col("p") <= closed).agg(F.min(sec).alias("lo"), F.max(sec).alias("hi"))


def chronological_split(df: DataFrame, bounds: DataFrame, ts: str = "feature_time", label: str = LABEL) -> DataFrame:
    """train / validation / test by position in the labelled time span; unlabelled rows are for inference."""
    both = bounds.select(F.struct("lo", "hi").alias("b")).scalar()  # one subquery for both ends
    lo, hi = both.getField("lo"), both.getField("hi")
    sec = F.unix_seconds(F.col(ts).cast("timestamp"))

    def limit(share: float):
        return lo + F.floor((hi - lo) * F.lit(share))

    split = (
        F.when(F.col(label).isNull(), "inference")
        .when(sec <= limit(TRAIN_SHARE), "train")
        .when(sec <= limit(VALIDATION_SHARE), "validation")
        .otherwise("test")
    )
    return df.withColumn("dataset_split", split)


def split_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy("dataset_split").agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"), F.count(F.lit(1)).alias("row_count")
    )


def require_trainable(df: DataFrame, label: str = LABEL) -> None:
    """Raise unless the labelled span is not empty and each split holds both classes."""
    found = {r["dataset_split"]: r for r in split_counts(df, label).collect()}  # four rows at most
    for name in ("train", "validation", "test"):
        r = found.get(name)
        if r is None or not r["positives"] or not r["negatives"]:
            raise ValueError(f"{name} must contain both positive and negative labels")


def feature_snapshots(src: FleetInputs, spans: Spans = Spans()) -> DataFrame:
    """Features, label, split and id of every snapshot."""
    cutoff = data_cutoff(src.telemetry, src.failures)
    labelled = label_with_horizon(snapshot_features(src, spans), cutoff, spans.horizon)
    split = chronological_split(labelled, grid_label_bounds(src.telemetry, cutoff, spans))
    text = F.concat_ws("|", F.col("asset_id").cast("string"), F.col("feature_time").cast("string"))
    return split.withColumn("snapshot_id", F.sha2(text, 256)).withColumn(
        "forecast_horizon_hours", F.lit(span(spans.horizon) // 3_600_000_000).cast("int")
    )
