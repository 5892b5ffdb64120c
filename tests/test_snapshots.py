"""Snapshots: the grid form equals the general operators; labels, splits and guards."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gaugework.plans import snapshots as snap
from gaugework.queries.fleet import SPANS, fleet_inputs

T = datetime(2024, 3, 1)


def test_grid_form_equals_the_general_operators(spark, tables):
    src = fleet_inputs(tables)
    names = ["asset_id", "feature_time", *snap.FEATURES, snap.LABEL_TIME]

    def rows(df):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect())

    grid, scan = rows(snap.snapshot_features(src, SPANS)), rows(snap.snapshot_features_by_scan(src, SPANS))
    assert grid and repr(grid) == repr(scan)


def test_spans_off_the_grid_are_refused():
    with pytest.raises(ValueError):
        snap.Spans("24 hours", "100 hours", "90 days").steps()


def one_asset(spark, failures, readings=(T + timedelta(hours=1),), meters=(), done=()):
    telemetry = spark.createDataFrame(
        [(1, t, i, 20.0 + i, 50.0, 10.0, 3) for i, t in enumerate(readings)],
        "asset_id int, event_time timestamp, event_id int, temperature double, cpu_load double, network_latency double, hardware_configuration_id int",
    )
    return snap.FleetInputs(
        telemetry,
        spark.createDataFrame([(1, t) for t in failures], "asset_id int, failure_time timestamp"),
        spark.createDataFrame([(1, t, i, v) for i, (t, v) in enumerate(meters)], "asset_id int, reading_time timestamp, meter_reading_id int, operating_hours double"),
        spark.createDataFrame([(1, t) for t in done], "asset_id int, completed_at timestamp"),
        spark.createDataFrame([(1, 2, 3)], "asset_id int, asset_type_id int, asset_model_id int"),
    )


def test_events_at_the_feature_time(spark):
    point, us = T + timedelta(days=1), timedelta(microseconds=1)
    src = one_asset(
        spark,
        [point, point, point - timedelta(days=90), point - timedelta(days=90) - us, point + timedelta(hours=168)],
        meters=[(point, 7.0), (point + us, 9.0)],
        done=[point],
    )
    r = snap.snapshot_features(src).first()
    assert r["feature_time"] == point
    assert r["failures_last_90d"] == 1  # only the one at t - 90 d
    assert r["label_failure_time"] == point + timedelta(hours=168)
    assert r["operating_hours"] == 7.0 and r["hours_since_maintenance"] == 0.0
    assert r["temperature_stddev"] is None and r["temperature_slope"] == 0.0


def test_a_failure_at_the_feature_time_is_no_label(spark):
    src = one_asset(spark, [T + timedelta(days=1)])
    r = snap.snapshot_features(src).first()
    assert r["label_failure_time"] is None and r["failures_last_90d"] == 0 and r["hours_since_maintenance"] is None


def test_label_closes_with_the_horizon(spark):
    rows = [(T, None), (T + timedelta(seconds=1), None)]
    df = spark.createDataFrame(rows, "feature_time timestamp, label_failure_time timestamp")
    cutoff = spark.createDataFrame([(T + timedelta(hours=168),)], "c timestamp")
    assert [r[snap.LABEL] for r in snap.label_with_horizon(df, cutoff).orderBy("feature_time").collect()] == [0, None]


def test_split_guard(spark):
    rows = [("train", 1), ("train", 0), ("validation", 1), ("validation", 0), ("test", 1)]
    df = spark.createDataFrame(rows, f"dataset_split string, {snap.LABEL} int")
    with pytest.raises(ValueError, match="test"):
        snap.require_trainable(df)
    snap.require_trainable(df.unionByName(spark.createDataFrame([("test", 0)], df.schema)))


def test_general_bounds_equal_the_grid_bounds(spark, tables):
    src = fleet_inputs(tables)
    cutoff = snap.data_cutoff(src.telemetry, src.failures)
    labelled = snap.label_with_horizon(snap.snapshot_features(src, SPANS), cutoff, SPANS.horizon)
    a, b = snap.label_bounds(labelled).first(), snap.grid_label_bounds(src.telemetry, cutoff, SPANS).first()
    assert (a["lo"], a["hi"]) == (b["lo"], b["hi"])


def test_a_hot_asset_changes_nothing_but_its_own_rows(spark, tables):
    """A third of all rows on one asset: counts stay whole."""
    src = fleet_inputs(tables)
    hot = src.telemetry.withColumn("asset_id", F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(5).cast("long")).otherwise(F.col("asset_id")))
    out = snap.snapshot_features(snap.FleetInputs(hot, src.failures, src.meters, src.maintenance, src.assets, src.metrics), SPANS)
    assert out.agg(F.sum("telemetry_count")).first()[0] == hot.count()
