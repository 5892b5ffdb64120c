"""Point-in-time snapshots and reliability reports over the fleet roles."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.classes import freshness
from ..functions.num import money, r6
from ..functions.when import micros, span
from ..operators.latest import latest_per_key
from ..operators.temporal import clip
from ..plans import reliability as rel
from ..plans import snapshots as snap
from ..plans.monitoring import eligible_latest
from .registry import query
from .roles import (
    AS_OF,
    METRICS,
    ORDERS_AS_OF,
    PERIOD,
    assets,
    components,
    details,
    failures,
    maintenance,
    meters,
    ntz,
    predictions,
    sql,
    states,
    telemetry,
    usage,
    work_orders,
)

SPANS = snap.Spans()  # the published ones: 24 hours, 168 hours, 90 days
DOUBLES = (
    "temperature_mean temperature_stddev temperature_min temperature_max temperature_slope cpu_mean cpu_p95 cpu_max "
    "latency_mean latency_p95 latency_max operating_hours hours_since_maintenance"
).split()


def fleet_inputs(t) -> snap.FleetInputs:
    register = assets(t).select("asset_id", "asset_type_id", "asset_model_id")
    failed = failures(t).withColumnRenamed("machine_id", "asset_id")
    return snap.FleetInputs(telemetry(t), failed, meters(t), maintenance(t), register, METRICS)


WINDOWS = """w AS (SELECT asset_id, time_bucket(INTERVAL '24 hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
    count(*) AS telemetry_count, avg(temperature) AS temperature_mean, stddev_samp(temperature) AS temperature_stddev,
    min(temperature) AS temperature_min, max(temperature) AS temperature_max,
    (arg_max(temperature, event_time) - arg_min(temperature, event_time)) / 24 AS temperature_slope,
    avg(cpu_load) AS cpu_mean, quantile_disc(cpu_load, 0.95) AS cpu_p95, max(cpu_load) AS cpu_max,
    avg(network_latency) AS latency_mean, quantile_disc(network_latency, 0.95) AS latency_p95, max(network_latency) AS latency_max,
    count(*) FILTER (WHERE temperature > 70) AS temperature_spike_count, count(*) FILTER (WHERE cpu_load > 90) AS cpu_spike_count,
    count(*) FILTER (WHERE network_latency > 150) AS latency_spike_count,
    arg_max(hardware_configuration_id, event_time) AS hardware_configuration_id
    FROM telemetry GROUP BY 1, 2)"""
POINTS = """s AS (SELECT *, window_start + INTERVAL 24 HOURS AS feature_time FROM w)"""
TIMED = """p AS (SELECT s.*,
    (SELECT arg_max(operating_hours, (reading_time, meter_reading_id)) FROM meters m WHERE m.asset_id = s.asset_id AND m.reading_time <= s.feature_time) AS operating_hours,
    (epoch_us(feature_time) - epoch_us((SELECT max(completed_at) FROM maintenance c WHERE c.asset_id = s.asset_id AND c.completed_at <= s.feature_time))) / 3600000000.0::DOUBLE AS hours_since_maintenance,
    (SELECT count(DISTINCT failure_time) FROM failures f WHERE f.machine_id = s.asset_id AND f.failure_time < s.feature_time AND f.failure_time >= s.feature_time - INTERVAL 90 DAYS) AS failures_last_90d,
    (SELECT min(failure_time) FROM failures f WHERE f.machine_id = s.asset_id AND f.failure_time > s.feature_time AND f.failure_time <= s.feature_time + INTERVAL 168 HOURS) AS label_failure_time
    FROM s)"""
LABELLED = """l AS (SELECT p.*, CASE WHEN feature_time <= (SELECT greatest((SELECT max(event_time) FROM telemetry), (SELECT max(failure_time) FROM failures))) - INTERVAL 168 HOURS
    THEN CAST(label_failure_time IS NOT NULL AS INTEGER) END AS label_failure_within_horizon FROM p)""", """b AS (SELECT min(epoch(feature_time))::BIGINT AS lo, max(epoch(feature_time))::BIGINT AS hi FROM l WHERE label_failure_within_horizon IS NOT NULL)""", """x AS (SELECT l.*, CASE WHEN label_failure_within_horizon IS NULL THEN 'inference'
    WHEN epoch(feature_time)::BIGINT <= lo + CAST(floor((hi - lo) * 0.70::DOUBLE) AS BIGINT) THEN 'train'
    WHEN epoch(feature_time)::BIGINT <= lo + CAST(floor((hi - lo) * 0.85::DOUBLE) AS BIGINT) THEN 'validation' ELSE 'test' END AS dataset_split FROM l, b)"""
ROUNDED = ", ".join(f"round({c}, 6) + 0 AS {c}" for c in DOUBLES)
SNAPSHOT_SQL = sql(
    "telemetry failures meters maintenance assets",
    f"""SELECT x.asset_id, feature_time, window_start, feature_time AS window_end, telemetry_count, {ROUNDED},
    temperature_spike_count, cpu_spike_count, latency_spike_count, failures_last_90d, hardware_configuration_id,
    asset_type_id, asset_model_id, label_failure_time, label_failure_within_horizon, dataset_split, 168 AS forecast_horizon_hours,
    sha256(CAST(x.asset_id AS VARCHAR) || '|' || strftime(feature_time, '%Y-%m-%d %H:%M:%S')) AS snapshot_id
    FROM x LEFT JOIN assets USING (asset_id)""",
    WINDOWS, POINTS, TIMED, *LABELLED,
)


def rounded(df, columns):
    return df.withColumns({c: r6(c) for c in columns})


@query("k01_feature_snapshot", SNAPSHOT_SQL)
def k01(t):
    return rounded(snap.feature_snapshots(fleet_inputs(t), SPANS), DOUBLES)


K_LABEL = sql("telemetry failures meters maintenance", "SELECT asset_id, feature_time, label_failure_within_horizon, label_failure_time FROM x", WINDOWS, POINTS, TIMED, *LABELLED)


@query("k02_label_with_horizon", K_LABEL)
def k02(t):
    src = fleet_inputs(t)
    features = snap.snapshot_features(src, SPANS).select("asset_id", "feature_time", snap.LABEL_TIME)
    out = snap.label_with_horizon(features, snap.data_cutoff(src.telemetry, src.failures), SPANS.horizon)
    return out.select("asset_id", "feature_time", snap.LABEL, snap.LABEL_TIME)


@query("k03_chronological_split", sql("telemetry failures meters maintenance", "SELECT dataset_split, label_failure_within_horizon, count(*) AS snapshots, min(feature_time) AS first_time, max(feature_time) AS last_time FROM x GROUP BY 1, 2", WINDOWS, POINTS, TIMED, *LABELLED))
def k03(t):
    full = snap.feature_snapshots(fleet_inputs(t), SPANS)
    return full.groupBy("dataset_split", snap.LABEL).agg(
        F.count(F.lit(1)).alias("snapshots"), F.min("feature_time").alias("first_time"), F.max("feature_time").alias("last_time")
    )


@query("k04_split_guard", sql("telemetry failures meters maintenance", """SELECT dataset_split, count(*) FILTER (WHERE label_failure_within_horizon = 1) AS positives,
    count(*) FILTER (WHERE label_failure_within_horizon = 0) AS negatives, count(*) AS row_count FROM x GROUP BY 1""", WINDOWS, POINTS, TIMED, *LABELLED))
def k04(t):
    return snap.split_counts(snap.feature_snapshots(fleet_inputs(t), SPANS))


@query("k05_mtbf_by_model", sql("assets meters failures", """SELECT asset_model_id, round(sum(operating_hours), 6) AS operating_hours, CAST(sum(coalesce(n, 0)) AS BIGINT) AS failures,
    round(sum(operating_hours) / nullif(sum(coalesce(n, 0)), 0), 6) AS mtbf_hours
    FROM assets JOIN m USING (asset_id) LEFT JOIN f USING (asset_id) GROUP BY 1""",
    "m AS (SELECT asset_id, arg_max(operating_hours, (reading_time, meter_reading_id)) AS operating_hours FROM meters GROUP BY 1)",
    "f AS (SELECT machine_id AS asset_id, count(*) AS n FROM failures GROUP BY 1)"))
def k05(t):
    return rounded(rel.mtbf_by(assets(t), meters(t), failures(t), ["asset_model_id"]), ["operating_hours", "mtbf_hours"])


@query("k06_mttr_by_type", sql("assets details", """SELECT asset_type_name, round(avg(downtime_minutes) / 60, 6) AS mttr_hours,
    round(sum(downtime_minutes) / 60, 6) AS total_downtime_hours, count(*) AS failure_count
    FROM details JOIN assets ON machine_id = asset_id WHERE planned = false GROUP BY 1"""))
def k06(t):
    return rounded(rel.mttr_by(assets(t), details(t), ["asset_type_name"]), ["mttr_hours", "total_downtime_hours"])


@query("k07_strict_mttr", sql("details", """SELECT round(avg(downtime_minutes) FILTER (WHERE planned = false AND restored_at <= TIMESTAMP '2024-01-31' AND downtime_minutes >= 0) / 60, 6) AS mttr_hours,
    count(*) FILTER (WHERE planned = false AND restored_at <= TIMESTAMP '2024-01-31' AND downtime_minutes >= 0) AS included_events, count(*) AS all_events FROM details"""))
def k07(t):
    return rounded(rel.strict_mttr(details(t), ntz(AS_OF)), ["mttr_hours"])


PERIOD_SQL = "TIMESTAMP '2024-01-08'", "TIMESTAMP '2024-01-29'"
LO, HI = PERIOD_SQL
HOURS_CTES = (
    f"""el AS (SELECT asset_id, greatest(coalesce(commissioned_at, installed_at), {LO}) AS b, least(coalesce(retired_at, {HI}), {HI}) AS e
        FROM assets WHERE coalesce(commissioned_at, installed_at) IS NOT NULL)""",
    "eh AS (SELECT asset_id, b, e, (epoch_us(e) - epoch_us(b)) / 3600000000.0::DOUBLE AS eligible_hours FROM el WHERE e > b)",
    f"""ob AS (SELECT eh.asset_id, operating_state, greatest(0, (epoch_us(least(coalesce(state_end, {HI}), {HI}, e)) - epoch_us(greatest(state_start, {LO}, b)))) / 3600000000.0::DOUBLE AS h
        FROM eh JOIN states s ON s.asset_id = eh.asset_id AND state_start < {HI} AND coalesce(state_end, {HI}) > {LO})""",
    """ah AS (SELECT eh.asset_id, any_value(eligible_hours) AS eligible_hours,
        coalesce(sum(h) FILTER (WHERE operating_state = 'running'), 0) AS running_hours, coalesce(sum(h) FILTER (WHERE operating_state = 'idle'), 0) AS idle_hours,
        coalesce(sum(h) FILTER (WHERE operating_state = 'maintenance'), 0) AS maintenance_hours, coalesce(sum(h) FILTER (WHERE operating_state = 'offline'), 0) AS offline_hours
        FROM eh LEFT JOIN ob USING (asset_id) GROUP BY 1)""",
)


def asset_hours(t):
    return rel.state_hours(states(t), assets(t), ntz(PERIOD[0]), ntz(PERIOD[1]))


@query("k08_observed_availability", sql("assets states", """SELECT asset_type_name, round(sum(running_hours + idle_hours), 6) AS up_hours,
    round(sum(running_hours + idle_hours + maintenance_hours + offline_hours), 6) AS observed_hours, round(sum(eligible_hours), 6) AS eligible_hours,
    round(sum(running_hours + idle_hours) / nullif(sum(running_hours + idle_hours + maintenance_hours + offline_hours), 0), 6) AS observed_availability,
    round(sum(running_hours + idle_hours + maintenance_hours + offline_hours) / nullif(sum(eligible_hours), 0), 6) AS coverage
    FROM ah JOIN assets USING (asset_id) GROUP BY 1""", *HOURS_CTES))
def k08(t):
    named = asset_hours(t).join(assets(t).select("asset_id", "asset_type_name"), "asset_id")
    out = rel.availability(named, ["asset_type_name"])
    return rounded(out, ["up_hours", "observed_hours", "eligible_hours", "observed_availability", "coverage"])


FAILURE_KEYS = """k AS (SELECT DISTINCT machine_id, failure_time FROM failures)""", """fe AS (SELECT k.machine_id, k.failure_time, asset_component_id, failure_mode_id, coalesce(severity, 'Unclassified') AS severity, restored_at, downtime_minutes,
    CASE WHEN planned IS NULL THEN 'Unknown' WHEN planned THEN 'Planned' ELSE 'Unplanned' END AS planned_status, d.machine_id IS NOT NULL AS has_details
    FROM k LEFT JOIN details d ON d.machine_id = k.machine_id AND d.failure_time = k.failure_time)"""


def events_of(t):
    return rel.canonical_failures(failures(t), details(t))


@query("k09_operating_mtbf", sql("assets states failures details", f"""SELECT round(sum(running_hours), 6) AS running_hours, CAST(sum(coalesce(n, 0)) AS BIGINT) AS unplanned_failures,
    round(sum(running_hours) / nullif(sum(coalesce(n, 0)), 0), 6) AS operating_mtbf_hours FROM ah LEFT JOIN
    (SELECT machine_id AS asset_id, count(*) AS n FROM fe WHERE planned_status = 'Unplanned' AND failure_time >= {LO} AND failure_time < {HI} GROUP BY 1) USING (asset_id)""", *HOURS_CTES, *FAILURE_KEYS))
def k09(t):
    out = rel.operating_mtbf(asset_hours(t), events_of(t), ntz(PERIOD[0]), ntz(PERIOD[1]))
    return rounded(out, ["running_hours", "operating_mtbf_hours"])


@query("k10_asset_register", sql("assets", """SELECT asset_id, asset_name, asset_type_name, n_name AS site_name, r_name AS customer_name, criticality FROM assets
    LEFT JOIN nation ON n_nationkey = site_id LEFT JOIN region ON r_regionkey = n_regionkey"""))
def k10(t):
    return (
        assets(t)
        .join(t.nation, F.col("site_id") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("asset_id", "asset_name", "asset_type_name", F.col("n_name").alias("site_name"), F.col("r_name").alias("customer_name"), "criticality")
    )


LATEST_RISK = """er AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY feature_time DESC, coalesce(scored_at, prediction_time) DESC, prediction_time DESC, prediction_id DESC) AS rn
    FROM predictions WHERE model_version = 'v0' AND feature_time <= TIMESTAMP '2024-01-29' AND prediction_time <= TIMESTAMP '2024-01-29' AND coalesce(scored_at, prediction_time) <= TIMESTAMP '2024-01-29') WHERE rn = 1)"""
SNAP_AT = datetime(2024, 1, 29)


@query("k11_asset_snapshot", sql("assets states telemetry meters failures details predictions", f"""SELECT a.asset_id, coalesce(st.operating_state, 'Unknown') AS operating_state, false AS state_overlap,
    te.event_time AS last_telemetry, te.value AS last_value, round(me.h, 6) AS meter_hours, fa.last_failure, coalesce(fa.n, 0) AS period_failures,
    CASE WHEN te.event_time IS NULL THEN 'missing' WHEN te.event_time >= {HI} - INTERVAL 24 HOURS THEN 'fresh' ELSE 'stale' END AS telemetry_status,
    er.failure_probability, er.risk_level
    FROM assets a LEFT JOIN (SELECT asset_id, operating_state FROM states WHERE state_start <= {HI} AND (state_end IS NULL OR state_end > {HI})) st USING (asset_id)
    LEFT JOIN (SELECT asset_id, max(event_time) AS event_time, arg_max(value, event_time) AS value FROM telemetry WHERE event_time <= {HI} GROUP BY 1) te USING (asset_id)
    LEFT JOIN (SELECT asset_id, arg_max(operating_hours, (reading_time, meter_reading_id)) AS h FROM meters WHERE reading_time <= {HI} GROUP BY 1) me USING (asset_id)
    LEFT JOIN (SELECT machine_id AS asset_id, max(failure_time) AS last_failure, count(*) FILTER (WHERE failure_time >= {LO}) AS n FROM fe WHERE failure_time < {HI} GROUP BY 1) fa USING (asset_id)
    LEFT JOIN er USING (asset_id)""", *FAILURE_KEYS, LATEST_RISK))
def k11(t):
    risk = eligible_latest(predictions(t), ntz(SNAP_AT), {"model_version": "v0"})
    out = rel.asset_snapshot(
        assets(t), states(t), telemetry(t), meters(t), events_of(t), risk, ntz(SNAP_AT), ntz(PERIOD[0]), ntz(PERIOD[1])
    )
    return rounded(out, ["meter_hours"])


@query("k12_telemetry_freshness", sql("assets telemetry", """SELECT CASE WHEN m IS NULL THEN 'missing' WHEN m >= TIMESTAMP '2024-01-30' THEN 'fresh' ELSE 'stale' END AS telemetry_status, count(*) AS assets
    FROM assets LEFT JOIN (SELECT asset_id, max(event_time) AS m FROM telemetry WHERE event_time <= TIMESTAMP '2024-01-31' GROUP BY 1) USING (asset_id) GROUP BY 1"""))
def k12(t):
    asked = micros(ntz(AS_OF))
    seen = telemetry(t).where(micros("event_time") <= asked).groupBy("asset_id").agg(F.max("event_time").alias("m"))
    status = freshness(asked - micros("m"), span("24 hours"))
    return assets(t).select("asset_id").join(seen, "asset_id", "left").groupBy(status.alias("telemetry_status")).agg(F.count(F.lit(1)).alias("assets"))


@query("k13_fleet_membership", sql("assets", """SELECT CASE WHEN coalesce(installed_at, commissioned_at) IS NULL THEN 'unknown_lifecycle'
    WHEN coalesce(installed_at, commissioned_at) > TIMESTAMP '2024-01-31' THEN 'not_installed' WHEN retired_at <= TIMESTAMP '2024-01-31' THEN 'retired'
    WHEN coalesce(commissioned_at, installed_at) > TIMESTAMP '2024-01-31' THEN 'awaiting_commissioning' ELSE 'active' END AS fleet_status, count(*) AS assets FROM assets GROUP BY 1"""))
def k13(t):
    return rel.lifecycle(assets(t), ntz(AS_OF)).groupBy("fleet_status").agg(F.count(F.lit(1)).alias("assets"))


@query("k14_reporting_period", sql("telemetry failures", """SELECT source, first_time, last_time, pe - INTERVAL 30 DAYS AS period_start, pe AS period_end FROM (
    SELECT 'telemetry' AS source, min(event_time) AS first_time, max(event_time) AS last_time FROM telemetry UNION ALL
    SELECT 'failures', min(failure_time), max(failure_time) FROM failures),
    (SELECT least(greatest((SELECT max(event_time) FROM telemetry WHERE event_time <= TIMESTAMP '2024-01-25'), (SELECT max(failure_time) FROM failures WHERE failure_time <= TIMESTAMP '2024-01-25')) + INTERVAL 1 MICROSECOND, TIMESTAMP '2024-01-25') AS pe)"""))
def k14(t):
    now = ntz(datetime(2024, 1, 25))
    return rel.reporting_period({"telemetry": (telemetry(t), "event_time"), "failures": (failures(t), "failure_time")}, now)


@query("k15_canonical_failures", sql("failures details", "SELECT machine_id, failure_time, asset_component_id, failure_mode_id, severity, planned_status, restored_at, round(downtime_minutes, 6) AS downtime_minutes, has_details FROM fe", *FAILURE_KEYS))
def k15(t):
    return rounded(events_of(t).drop("planned"), ["downtime_minutes"])


@query("k16_failure_trend", sql("failures details", """SELECT date_trunc('day', failure_time)::TIMESTAMP AS bucket_start, severity, count(*) AS failures, count(DISTINCT machine_id) AS affected_assets FROM fe GROUP BY 1, 2""", *FAILURE_KEYS))
def k16(t):
    return rel.failure_trend(events_of(t), by=["severity"])


@query("k16_failure_breakdown", sql("failures details assets", """SELECT asset_type_name, severity, count(*) AS failures, count(DISTINCT machine_id) AS affected_assets,
    count(*) - count(DISTINCT machine_id) AS repeat_failures, round(coalesce(sum(downtime_minutes) FILTER (WHERE downtime_minutes >= 0), 0) / 60, 6) AS downtime_hours
    FROM fe LEFT JOIN assets ON asset_id = machine_id GROUP BY 1, 2""", *FAILURE_KEYS))
def k16b(t):
    """Type is a property of the asset, so failures are reduced per asset before the register is joined."""
    return rounded(rel.failure_breakdown(events_of(t), ["severity"], assets(t), ["asset_type_name"]), ["downtime_hours"])


REGISTER = """reg AS (SELECT asset_id, asset_model_id, asset_type_name, n_name AS site_name, r_name AS customer_name FROM assets
    LEFT JOIN nation ON n_nationkey = site_id LEFT JOIN region ON r_regionkey = n_regionkey)"""
BROKEN_DOWN = """count(*) AS failures, count(DISTINCT machine_id) AS affected_assets, count(*) - count(DISTINCT machine_id) AS repeat_failures,
    round(coalesce(sum(downtime_minutes) FILTER (WHERE downtime_minutes >= 0), 0) / 60, 6) AS downtime_hours"""


def register(t):
    named = assets(t).join(t.nation, F.col("site_id") == F.col("n_nationkey"), "left").join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return named.select("asset_id", "asset_model_id", "asset_type_name", F.col("n_name").alias("site_name"), F.col("r_name").alias("customer_name"))


def breakdown_sql(column, join="LEFT JOIN reg ON asset_id = machine_id"):
    return sql("failures details assets", f"SELECT {column}, {BROKEN_DOWN} FROM fe {join} GROUP BY 1", *FAILURE_KEYS, REGISTER)


@query("k16_failures_by_customer", breakdown_sql("customer_name"))
def k16_customer(t):
    return rounded(rel.failure_breakdown(events_of(t), [], register(t), ["customer_name"]), ["downtime_hours"])


@query("k16_failures_by_site", breakdown_sql("site_name"))
def k16_site(t):
    return rounded(rel.failure_breakdown(events_of(t), [], register(t), ["site_name"]), ["downtime_hours"])


@query("k16_failures_by_model", breakdown_sql("asset_model_id"))
def k16_model(t):
    return rounded(rel.failure_breakdown(events_of(t), [], register(t), ["asset_model_id"]), ["downtime_hours"])


@query("k16_failures_by_mode", breakdown_sql("failure_mode_id", ""))
def k16_mode(t):
    return rounded(rel.failure_breakdown(events_of(t), ["failure_mode_id"]), ["downtime_hours"])


@query("k17_enrichment_coverage", sql("failures details", "SELECT count(*) AS failures, count(*) FILTER (WHERE has_details) AS enriched, round(avg(CAST(has_details AS INTEGER)), 6) AS coverage FROM fe", *FAILURE_KEYS))
def k17(t):
    return events_of(t).agg(
        F.count(F.lit(1)).alias("failures"), F.count_if("has_details").alias("enriched"), r6(F.avg(F.col("has_details").cast("double"))).alias("coverage")
    )


@query("k18_event_downtime", sql("failures details", f"SELECT planned_status, count(*) AS failures, count(downtime_minutes) AS timed, round(sum(downtime_minutes) FILTER (WHERE downtime_minutes >= 0) / 60, 6) AS downtime_hours FROM fe WHERE failure_time >= {LO} AND failure_time < {HI} GROUP BY 1", *FAILURE_KEYS))
def k18(t):
    at = F.col("failure_time")
    return events_of(t).where((at >= ntz(PERIOD[0])) & (at < ntz(PERIOD[1]))).groupBy("planned_status").agg(
        F.count(F.lit(1)).alias("failures"),
        F.count("downtime_minutes").alias("timed"),
        r6(F.sum(F.when(F.col("downtime_minutes") >= 0, F.col("downtime_minutes"))) / 60).alias("downtime_hours"),
    )


INSTALLED = "installed_at <= TIMESTAMP '2000-01-01' AND (removed_at IS NULL OR removed_at > TIMESTAMP '2000-01-01')"


@query("k19_installed_components", sql("components", f"""SELECT part_id, count(DISTINCT asset_component_id) FILTER (WHERE {INSTALLED}) AS installed_components,
    count(DISTINCT asset_id) FILTER (WHERE {INSTALLED}) AS assets_using_part, count(*) FILTER (WHERE ({INSTALLED}) <> active) AS flag_conflicts FROM components GROUP BY 1"""))
def k19(t):
    return components(t).withColumn("_in", rel.installed_at(ntz(ORDERS_AS_OF))).groupBy("part_id").agg(
        F.count_distinct(F.when(F.col("_in"), F.col("asset_component_id"))).alias("installed_components"),
        F.count_distinct(F.when(F.col("_in"), F.col("asset_id"))).alias("assets_using_part"),
        F.count_if(F.col("_in") != F.col("active")).alias("flag_conflicts"),
    )


@query("k20_part_usage", sql("usage", """SELECT part_id, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(line_cost) AS DECIMAL(18,2)) AS known_cost, count(line_cost) AS priced_lines, count(*) AS usage_lines,
    round(count(line_cost) / count(*), 6) AS price_coverage FROM usage GROUP BY 1"""))
def k20(t):
    return usage(t).groupBy("part_id").agg(
        F.sum("quantity").alias("quantity"),
        money(F.sum("line_cost")).alias("known_cost"),
        F.count("line_cost").alias("priced_lines"),
        F.count(F.lit(1)).alias("usage_lines"),
        r6(F.count("line_cost") / F.count(F.lit(1))).alias("price_coverage"),
    )


@query("k20_usage_by_type_and_month", sql("usage work_orders assets", """SELECT date_trunc('month', opened_at)::TIMESTAMP AS month_start, asset_type_name, CAST(sum(quantity) AS BIGINT) AS quantity,
    CAST(sum(line_cost) AS DECIMAL(18,2)) AS known_cost, count(*) AS usage_lines FROM usage JOIN work_orders USING (work_order_id) LEFT JOIN assets USING (asset_id) GROUP BY 1, 2"""))
def k20b(t):
    month = F.date_trunc("month", "opened_at").cast("timestamp_ntz").alias("month_start")
    return used_by_asset(t, month).join(assets(t).select("asset_id", "asset_type_name"), "asset_id", "left").groupBy("month_start", "asset_type_name").agg(
        F.sum("quantity").alias("quantity"), money(F.sum("cost")).alias("known_cost"), F.sum("lines").alias("usage_lines")
    )


@query("k20_usage_by_customer", sql("usage work_orders assets", """SELECT customer_name, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(line_cost) AS DECIMAL(18,2)) AS known_cost, count(*) AS usage_lines
    FROM usage JOIN work_orders USING (work_order_id) LEFT JOIN reg USING (asset_id) GROUP BY 1""", REGISTER))
def k20c(t):
    return used_by_asset(t).join(register(t).select("asset_id", "customer_name"), "asset_id", "left").groupBy("customer_name").agg(
        F.sum("quantity").alias("quantity"), money(F.sum("cost")).alias("known_cost"), F.sum("lines").alias("usage_lines")
    )


def used_by_asset(t, *by):
    """Parts used, by the asset of the order; lines are reduced to the order before they meet it."""
    per_order = usage(t).groupBy("work_order_id").agg(F.sum("quantity").alias("q"), F.sum("line_cost").alias("c"), F.count(F.lit(1)).alias("n"))
    joined = per_order.join(work_orders(t).select("work_order_id", "asset_id", "opened_at"), "work_order_id")
    return joined.groupBy("asset_id", *by).agg(F.sum("q").alias("quantity"), F.sum("c").alias("cost"), F.sum("n").alias("lines"))


@query("k21_part_attributed_failures", sql("failures details components", """SELECT p_brand, count(*) AS failures, count(DISTINCT machine_id) AS affected_assets FROM fe
    JOIN components USING (asset_component_id) JOIN part ON p_partkey = part_id GROUP BY 1""", *FAILURE_KEYS))
def k21(t):
    """The failing component leads to the part that is installed as it; failures without a known component have no part."""
    linked = events_of(t).where("asset_component_id IS NOT NULL").join(components(t).select("asset_component_id", "part_id"), "asset_component_id")
    return linked.join(t.part.select("p_partkey", "p_brand"), F.col("part_id") == F.col("p_partkey")).groupBy("p_brand").agg(
        F.count(F.lit(1)).alias("failures"), F.count_distinct("machine_id").alias("affected_assets")
    )


@query("k22_component_age", sql("meters", """SELECT c.asset_component_id, c.asset_id, round(CASE WHEN h - c.m >= 0 THEN h - c.m END, 6) AS component_age_hours FROM
    (SELECT event_id AS asset_component_id, user_id AS asset_id, value * 10 AS m FROM events WHERE event_type = 'click') c
    LEFT JOIN (SELECT asset_id, arg_max(operating_hours, (reading_time, meter_reading_id)) AS h FROM meters WHERE reading_time <= TIMESTAMP '2024-01-29' GROUP BY 1) USING (asset_id)"""))
def k22(t):
    parts = t.events.where("event_type = 'click'").select(
        F.col("event_id").alias("asset_component_id"), F.col("user_id").alias("asset_id"), (F.col("value") * 10).alias("installation_meter_hours"),
        F.lit(None).cast("double").alias("removal_meter_hours"),
    )
    return rounded(rel.component_age(parts, meters(t), ntz(SNAP_AT)).select("asset_component_id", "asset_id", "component_age_hours"), ["component_age_hours"])


@query("k23_order_and_material_cost", sql("work_orders usage", """SELECT status, count(*) AS orders, CAST(sum(total_cost) AS DECIMAL(18,2)) AS order_cost, CAST(sum(mat) AS DECIMAL(18,2)) AS material_cost, CAST(coalesce(sum(lines), 0) AS BIGINT) AS usage_lines
    FROM work_orders LEFT JOIN (SELECT work_order_id, sum(line_cost) AS mat, count(*) AS lines FROM usage GROUP BY 1) USING (work_order_id) GROUP BY 1"""))
def k23(t):
    material = usage(t).groupBy("work_order_id").agg(F.sum("line_cost").alias("mat"), F.count(F.lit(1)).alias("lines"))
    return work_orders(t).join(material, "work_order_id", "left").groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"),
        money(F.sum("total_cost")).alias("order_cost"),
        money(F.sum("mat")).alias("material_cost"),
        F.coalesce(F.sum("lines"), F.lit(0)).alias("usage_lines"),
    )


@query("k24_overdue_backlog", sql("work_orders", "SELECT work_order_id, asset_id, status, priority, scheduled_at, date_diff('day', scheduled_at, TIMESTAMP '2000-01-01') AS days_overdue FROM work_orders WHERE status <> 'completed' AND scheduled_at < TIMESTAMP '2000-01-01'"))
def k24(t):
    due = work_orders(t).where((F.col("status") != "completed") & (F.col("scheduled_at") < ntz(ORDERS_AS_OF)))
    return due.select("work_order_id", "asset_id", "status", "priority", "scheduled_at", F.datediff(ntz(ORDERS_AS_OF), "scheduled_at").cast("long").alias("days_overdue"))


@query("k25_maintenance_throughput", sql("work_orders assets", """SELECT date_trunc('month', completed_at)::TIMESTAMP AS month_start, asset_type_name, count(*) AS completed, CAST(sum(total_cost) AS DECIMAL(18,2)) AS cost
    FROM work_orders JOIN assets USING (asset_id) WHERE status = 'completed' GROUP BY 1, 2"""))
def k25(t):
    done = work_orders(t).where("status = 'completed'")
    per_asset = done.groupBy("asset_id", F.date_trunc("month", "completed_at").cast("timestamp_ntz").alias("month_start")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_cost").alias("c")
    )
    return per_asset.join(assets(t).select("asset_id", "asset_type_name"), "asset_id").groupBy("month_start", "asset_type_name").agg(
        F.sum("n").alias("completed"), money(F.sum("c")).alias("cost")
    )


@query("k25_cost_by_asset", sql("work_orders", "SELECT asset_id, count(*) AS completed, CAST(sum(total_cost) AS DECIMAL(18,2)) AS cost FROM work_orders WHERE status = 'completed' GROUP BY 1"))
def k25b(t):
    return work_orders(t).where("status = 'completed'").groupBy("asset_id").agg(F.count(F.lit(1)).alias("completed"), money(F.sum("total_cost")).alias("cost"))


@query("k25_cost_by_customer", sql("work_orders assets", "SELECT customer_name, count(*) AS completed, CAST(sum(total_cost) AS DECIMAL(18,2)) AS cost FROM work_orders LEFT JOIN reg USING (asset_id) WHERE status = 'completed' GROUP BY 1", REGISTER))
def k25c(t):
    per_asset = work_orders(t).where("status = 'completed'").groupBy("asset_id").agg(F.count(F.lit(1)).alias("n"), F.sum("total_cost").alias("c"))
    return per_asset.join(register(t).select("asset_id", "customer_name"), "asset_id", "left").groupBy("customer_name").agg(
        F.sum("n").alias("completed"), money(F.sum("c")).alias("cost")
    )


@query("k26_state_timeline", sql("states", f"""SELECT state_id, asset_id, operating_state, greatest(state_start, {LO}) AS clipped_start, least(coalesce(state_end, {HI}), {HI}) AS clipped_end,
    round((epoch_us(least(coalesce(state_end, {HI}), {HI})) - epoch_us(greatest(state_start, {LO}))) / 3600000000.0::DOUBLE, 6) AS hours FROM states
    WHERE least(coalesce(state_end, {HI}), {HI}) > greatest(state_start, {LO})"""))
def k26(t):
    cut = clip(states(t), "state_start", "state_end", ntz(PERIOD[0]), ntz(PERIOD[1]))
    return rounded(cut.select("state_id", "asset_id", "operating_state", "clipped_start", "clipped_end", "hours"), ["hours"])


@query("k27_site_map", """SELECT n_nationkey AS site_id, any_value(n_name) AS site_name, round(n_nationkey * 6.0::DOUBLE - 60, 6) AS latitude, round(avg(s_acctbal) / 60, 6) AS longitude FROM nation JOIN supplier ON s_nationkey = n_nationkey
    GROUP BY 1 HAVING n_nationkey * 6.0 - 60 BETWEEN -90 AND 90 AND avg(s_acctbal) / 60 BETWEEN -180 AND 180""")
def k27(t):
    """Coordinates derived per nation; only valid ones are shown, one row per site."""
    spots = t.supplier.groupBy(F.col("s_nationkey").alias("site_id")).agg((F.avg("s_acctbal") / 60).alias("longitude"))
    sites = t.nation.select(F.col("n_nationkey").alias("site_id"), F.col("n_name").alias("site_name"), (F.col("n_nationkey") * 6.0 - 60).alias("latitude"))
    valid = F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180)
    return rounded(sites.join(spots, "site_id").where(valid), ["latitude", "longitude"])


@query("k28_sales_by_year_category", """SELECT CAST(year(o_orderdate) AS INTEGER) AS d_year, p_type AS i_category, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sales, CAST(sum(l_quantity) AS BIGINT) AS quantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def k28(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", money("l_extendedprice").alias("ext"), F.col("l_quantity").cast("long").alias("q"))
    typed = lines.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    # reduced to (order, category) before the large join with the orders
    per_order = typed.groupBy("l_orderkey", "p_type").agg(F.sum("ext").alias("ext"), F.sum("q").alias("q"))
    dated = per_order.join(t.orders.select("o_orderkey", F.year("o_orderdate").alias("d_year")), F.col("l_orderkey") == F.col("o_orderkey"))
    return dated.groupBy("d_year", F.col("p_type").alias("i_category")).agg(money(F.sum("ext")).alias("sales"), F.sum("q").alias("quantity"))


@query("k29_load_checks", "SELECT count(*) AS row_count, min(l_shipdate) AS first_date, max(l_shipdate) AS last_date, count(DISTINCT l_partkey) AS distinct_items FROM lineitem")
def k29(t):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("row_count"), F.min("l_shipdate").alias("first_date"), F.max("l_shipdate").alias("last_date"), F.count_distinct("l_partkey").alias("distinct_items")
    )


@query("k30_reading_summary", "SELECT count(*) AS readings, min(ts) AS first_reading, max(ts) AS last_reading FROM events WHERE event_type = 'signup'")
def k30(t):
    return t.events.where("event_type = 'signup'").agg(F.count(F.lit(1)).alias("readings"), F.min("ts").alias("first_reading"), F.max("ts").alias("last_reading"))


CACHE_SQL = """c AS (SELECT asset_id, feature_time, TIMESTAMP '2024-01-31' AS scored_at, failure_probability, risk_level,
    CASE WHEN feature_time IS NULL THEN 'missing_features' WHEN feature_time + INTERVAL 72 HOURS <= TIMESTAMP '2024-01-31' THEN 'expired' ELSE 'scored' END AS prediction_status
    FROM assets LEFT JOIN (SELECT asset_id, max(feature_time) AS feature_time, arg_max(failure_probability, (prediction_time, prediction_id)) AS failure_probability, arg_max(risk_level, (prediction_time, prediction_id)) AS risk_level FROM predictions GROUP BY 1) USING (asset_id))"""


def prediction_cache(t):
    newest = latest_per_key(predictions(t), ["asset_id"], ["prediction_time", "prediction_id"], ["prediction_time", "prediction_id", "feature_time", "failure_probability", "risk_level"])
    scored_at = ntz(AS_OF)
    status = (
        F.when(F.col("feature_time").isNull(), "missing_features")
        .when(micros("feature_time") + span("72 hours") <= micros(scored_at), "expired")
        .otherwise("scored")
    )
    return (
        assets(t).select("asset_id").join(newest, "asset_id", "left")
        .select("asset_id", "feature_time", scored_at.alias("scored_at"), "failure_probability", "risk_level", status.alias("prediction_status"))
    )


@query("k31_prediction_cache", sql("assets predictions", "SELECT * FROM c", CACHE_SQL))
def k31(t):
    return prediction_cache(t)


@query("k32_current_risk", sql("assets predictions", "SELECT asset_id, feature_time, failure_probability, risk_level FROM c WHERE prediction_status = 'scored' AND feature_time + INTERVAL 72 HOURS > TIMESTAMP '2024-01-31'", CACHE_SQL))
def k32(t):
    open_horizon = micros("feature_time") + span("72 hours") > micros(ntz(AS_OF))
    return prediction_cache(t).where((F.col("prediction_status") == "scored") & open_horizon).select("asset_id", "feature_time", "failure_probability", "risk_level")
