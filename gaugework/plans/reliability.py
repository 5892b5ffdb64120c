"""Fleet reliability reports. Facts are reduced to the asset before any dimension is joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.classes import freshness
from ..functions.num import ratio
from ..functions.when import hours, instant, micros, span, whole
from ..operators.latest import latest_per_key
from ..operators.temporal import clip, covering_at

UP_STATES, ALL_STATES = ("running", "idle"), ("running", "idle", "maintenance", "offline")


def canonical_failures(failures: DataFrame, details: DataFrame) -> DataFrame:
    """Distinct (machine_id, failure_time) events with their details; events without details stay."""
    keys = failures.select("machine_id", "failure_time").where("machine_id IS NOT NULL AND failure_time IS NOT NULL").distinct()
    return keys.join(details.withColumn("_detailed", F.lit(True)), ["machine_id", "failure_time"], "left").withColumns(
        {
            "severity": F.coalesce("severity", F.lit("Unclassified")),
            "planned_status": F.when(F.col("planned").isNull(), "Unknown").when(F.col("planned"), "Planned").otherwise("Unplanned"),
            "has_details": F.coalesce("_detailed", F.lit(False)),
        }
    ).drop("_detailed")


def latest_meter(meters: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Latest reading per asset by (reading_time, meter_reading_id), not the highest value."""
    rows = meters if as_of is None else meters.where(micros("reading_time") <= micros(as_of))
    return latest_per_key(rows, ["asset_id"], ["reading_time", "meter_reading_id"], ["reading_time", "meter_reading_id", "operating_hours"])


def mtbf_by(assets: DataFrame, meters: DataFrame, failures: DataFrame, by: Sequence[str]) -> DataFrame:
    """Operating hours over failures, sums first; null without failures. Only metered assets count."""
    n = failures.groupBy(F.col("machine_id").alias("asset_id")).agg(F.count(F.lit(1)).alias("failures"))
    per_asset = assets.join(latest_meter(meters).select("asset_id", "operating_hours"), "asset_id").join(n, "asset_id", "left")
    sums = per_asset.groupBy(*by).agg(
        F.sum("operating_hours").alias("operating_hours"), F.sum(F.coalesce("failures", F.lit(0))).alias("failures")
    )
    return sums.withColumn("mtbf_hours", ratio("operating_hours", "failures"))


def mttr_by(assets: DataFrame, details: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean and total recorded downtime of unplanned failures."""
    per_asset = (
        details.where(~F.col("planned"))
        .groupBy(F.col("machine_id").alias("asset_id"))
        .agg(F.sum("downtime_minutes").alias("m"), F.count("downtime_minutes").alias("timed"), F.count(F.lit(1)).alias("n"))
    )
    sums = per_asset.join(assets, "asset_id").groupBy(*by).agg(F.sum("m").alias("m"), F.sum("timed").alias("t"), F.sum("n").alias("failure_count"))
    return sums.select(
        *by, ratio(F.col("m") / 60, F.col("t")).alias("mttr_hours"), (F.col("m") / 60).alias("total_downtime_hours"), "failure_count"
    )


def strict_mttr(details: DataFrame, as_of: Column) -> DataFrame:
    """MTTR over unplanned events restored by ``as_of`` with a non-negative duration."""
    ok = (~F.col("planned")) & (micros("restored_at") <= micros(as_of)) & (F.col("downtime_minutes") >= 0)
    picked = F.when(ok, F.col("downtime_minutes"))
    return details.agg(
        (F.avg(picked) / 60).alias("mttr_hours"), F.count(picked).alias("included_events"), F.count(F.lit(1)).alias("all_events")
    )


def service_bounds(assets: DataFrame) -> DataFrame:
    """Service period per asset: from commissioning, else installation, to retirement."""
    return assets.select(
        "asset_id", F.coalesce("commissioned_at", "installed_at").alias("service_start"), F.col("retired_at").alias("service_end")
    ).where("service_start IS NOT NULL")


def state_hours(intervals: DataFrame, assets: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Hours per asset and state within the period and the asset's service, plus the hours it could have."""
    service = service_bounds(assets)
    begin = F.greatest(micros("service_start"), micros(lo))
    finish = F.least(F.coalesce(micros("service_end"), micros(hi)), micros(hi))
    eligible = service.select("asset_id", begin.alias("_b"), finish.alias("_e")).where("_e > _b")
    # the sums group by the join key again, which would keep a hot asset in one task; between join and sums
    # the rows are rebalanced by size, so that adaptive execution may split the join and sums start partial
    clipped = clip(intervals, "state_start", "state_end", lo, hi)
    a, b = micros("clipped_start"), micros("clipped_end")
    cells = clipped.select("asset_id", "operating_state", a.alias("_a"), b.alias("_z"))
    inside = F.greatest(F.least(F.col("_z"), F.col("_e")) - F.greatest(F.col("_a"), F.col("_b")), F.lit(0))
    in_period = cells.join(eligible, "asset_id").select("asset_id", "operating_state", inside.alias("_us")).hint("rebalance")
    per_state = [F.sum(F.when(F.col("operating_state") == s, F.col("_us"))).alias(f"{s}_us") for s in ALL_STATES]
    observed = in_period.groupBy("asset_id").agg(*per_state)
    joined = eligible.select("asset_id", (F.col("_e") - F.col("_b")).alias("eligible_us")).join(observed, "asset_id", "left")
    zero = F.lit(0)
    return joined.select(
        "asset_id",
        hours(F.col("eligible_us")).alias("eligible_hours"),
        *[hours(F.coalesce(f"{s}_us", zero)).alias(f"{s}_hours") for s in ALL_STATES],
    )


def availability(hours_by_asset: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(running + idle) over classified hours, with coverage of eligible hours; gaps are not uptime."""
    up = sum((F.sum(f"{s}_hours") for s in UP_STATES[1:]), F.sum(f"{UP_STATES[0]}_hours"))
    seen = sum((F.sum(f"{s}_hours") for s in ALL_STATES[1:]), F.sum(f"{ALL_STATES[0]}_hours"))
    sums = hours_by_asset.groupBy(*by).agg(up.alias("up_hours"), seen.alias("observed_hours"), F.sum("eligible_hours").alias("eligible_hours"))
    return sums.select(
        *by,
        "up_hours",
        "observed_hours",
        "eligible_hours",
        ratio("up_hours", "observed_hours").alias("observed_availability"),
        ratio("observed_hours", "eligible_hours").alias("coverage"),
    )


def operating_mtbf(hours_by_asset: DataFrame, failures: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Running hours over unplanned failures of the same assets and period; null without failures."""
    at = micros("failure_time")
    n = (
        failures.where((F.col("planned_status") == "Unplanned") & (at >= micros(lo)) & (at < micros(hi)))
        .groupBy(F.col("machine_id").alias("asset_id"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    sums = hours_by_asset.join(n, "asset_id", "left").agg(
        F.sum("running_hours").alias("running_hours"), F.sum(F.coalesce("n", F.lit(0))).alias("unplanned_failures")
    )
    return sums.withColumn("operating_mtbf_hours", ratio("running_hours", "unplanned_failures"))


def asset_snapshot(
    assets: DataFrame,
    states: DataFrame,
    telemetry: DataFrame,
    meters: DataFrame,
    failures: DataFrame,
    predictions: DataFrame,
    as_of: Column,
    lo: Column,
    hi: Column,
    stale_after: str = "24 hours",
) -> DataFrame:
    """Exactly one row per asset. Every source is reduced to one row per asset before the join."""
    asked = micros(as_of)
    state = covering_at(states, ["asset_id"], "state_start", "state_end", as_of, {"operating_state": "operating_state"}, ["state_id"])
    seen = latest_per_key(
        telemetry.where(micros("event_time") <= asked), ["asset_id"], ["event_time", "event_id"], ["event_time", "event_id", "value"]
    ).select("asset_id", F.col("event_time").alias("last_telemetry"), F.col("value").alias("last_value"))
    meter = latest_meter(meters, as_of).select("asset_id", F.col("operating_hours").alias("meter_hours"))
    at = micros("failure_time")
    failed = (
        failures.where(at <= asked)
        .groupBy(F.col("machine_id").alias("asset_id"))
        .agg(F.max("failure_time").alias("last_failure"), F.count_if((at >= micros(lo)) & (at < micros(hi))).alias("period_failures"))
    )
    risk = predictions.select("asset_id", "failure_probability", "risk_level")
    out = assets.select("asset_id")
    for part in (state, seen, meter, failed, risk):
        out = out.join(part, "asset_id", "left")
    return out.withColumns(
        {
            "operating_state": F.coalesce("operating_state", F.lit("Unknown")),
            "state_overlap": F.coalesce(F.col("covering") > 1, F.lit(False)),
            "period_failures": F.coalesce("period_failures", F.lit(0)),
            "telemetry_status": freshness(asked - micros("last_telemetry"), span(stale_after)),
        }
    ).drop("covering")


def lifecycle(assets: DataFrame, as_of: Column) -> DataFrame:
    """Membership of each asset at an instant: active, awaiting commissioning, retired, not installed or unknown."""
    asked = micros(as_of)
    begin = F.coalesce(micros("installed_at"), micros("commissioned_at"))
    status = (
        F.when(begin.isNull(), "unknown_lifecycle")
        .when(begin > asked, "not_installed")
        .when(micros("retired_at") <= asked, "retired")
        .when(F.coalesce(micros("commissioned_at"), begin) > asked, "awaiting_commissioning")
        .otherwise("active")
    )
    return assets.withColumn("fleet_status", status)


def reporting_period(sources: dict[str, tuple[DataFrame, str]], now: Column, days: int = 30) -> DataFrame:
    """Per source its date coverage, with the shared default period.

    The period ends one microsecond after the latest instant that is not in the future, at most
    ``now``, and begins ``days`` earlier.
    """
    parts = None
    for name, (df, ts) in sources.items():
        one = df.agg(
            F.min(micros(ts)).alias("first_us"),
            F.max(micros(ts)).alias("last_us"),
            F.max(F.when(micros(ts) <= micros(now), micros(ts))).alias("past_us"),
        ).select(F.lit(name).alias("source"), "*")
        parts = one if parts is None else parts.unionByName(one)
    end = parts.agg(F.least(F.max("past_us") + 1, micros(now)).alias("e")).scalar()
    return parts.select(
        "source",
        instant(F.col("first_us")).alias("first_time"),
        instant(F.col("last_us")).alias("last_time"),
        instant(end - F.lit(days * 86_400_000_000)).alias("period_start"),
        instant(end).alias("period_end"),
    )


def failure_trend(failures: DataFrame, width: str = "24 hours", by: Sequence[str] = ()) -> DataFrame:
    bucket = whole(micros("failure_time"), span(width)) * F.lit(span(width))
    return failures.groupBy(instant(bucket).alias("bucket_start"), *by).agg(
        F.count(F.lit(1)).alias("failures"), F.count_distinct("machine_id").alias("affected_assets")
    )


def failure_breakdown(failures: DataFrame, by: Sequence[str] = (), register: DataFrame | None = None, register_by: Sequence[str] = ()) -> DataFrame:
    """Failures, affected assets, repeat failures and recorded downtime, negative downtime left out.

    ``by`` are columns of the failures, ``register_by`` of the asset register, which is joined after the
    failures have been reduced to the asset.
    """
    known = F.when(F.col("downtime_minutes") >= 0, F.col("downtime_minutes"))
    per_asset = failures.groupBy(*by, "machine_id").agg(F.count(F.lit(1)).alias("n"), F.sum(known).alias("m"))
    if register is not None:
        names = register.select(F.col("asset_id").alias("machine_id"), *register_by)
        per_asset = per_asset.join(names, "machine_id", "left")
    return per_asset.groupBy(*by, *register_by).agg(
        F.sum("n").alias("failures"),
        F.count_distinct("machine_id").alias("affected_assets"),
        (F.sum("n") - F.count_distinct("machine_id")).alias("repeat_failures"),
        (F.coalesce(F.sum("m"), F.lit(0.0)) / 60).alias("downtime_hours"),
    )


def component_age(components: DataFrame, meters: DataFrame, as_of: Column) -> DataFrame:
    """Operating age of installed components; null when the meter is missing or below the install value."""
    meter = latest_meter(meters, as_of).select("asset_id", F.col("operating_hours").alias("meter_hours"))
    reached = F.coalesce(F.col("removal_meter_hours"), F.col("meter_hours"))
    age = reached - F.col("installation_meter_hours")
    return components.join(meter, "asset_id", "left").withColumn("component_age_hours", F.when(age >= 0, age))


def installed_at(as_of: Column) -> Column:
    asked = micros(as_of)
    return (micros("installed_at") <= asked) & (F.col("removed_at").isNull() | (micros("removed_at") > asked))
