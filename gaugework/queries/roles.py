"""The fleet roles played by the given tables, as DataFrames and as SQL common table expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..functions.classes import first_band, risk_level, severity
from ..functions.when import instant, micros
from ..operators.features import Metric
from ..operators.temporal import with_neighbours
from ..sources.tables import Tables

AS_OF = datetime(2024, 1, 31)
PERIOD = (datetime(2024, 1, 8), datetime(2024, 1, 29))
ORDERS_AS_OF = datetime(2000, 1, 1)
BASE_US = 1_704_067_200_000_000  # 2024-01-01
THRESHOLD = 0.5
METRICS = (
    Metric("temperature", "temperature", ("mean", "stddev", "min", "max", "slope", "spike_count"), 70.0),
    Metric("cpu", "cpu_load", ("mean", "p95", "max", "spike_count"), 90.0),
    Metric("latency", "network_latency", ("mean", "p95", "max", "spike_count"), 150.0),
)


def ntz(moment: datetime):
    return F.lit(moment).cast("timestamp_ntz")


def telemetry(t: Tables) -> DataFrame:
    return t.events.where("event_type <> 'error'").select(
        F.col("user_id").alias("asset_id"),
        F.col("ts").alias("event_time"),
        "event_id",
        "value",
        F.col("value").alias("temperature"),
        F.least(F.lit(100.0), F.col("value") * 1.5).alias("cpu_load"),
        (F.col("value") * 3).alias("network_latency"),
        F.pmod(F.floor("value"), F.lit(25)).cast("int").alias("hardware_configuration_id"),
    )


def failures(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'error'").select(F.col("user_id").alias("machine_id"), F.col("ts").alias("failure_time"))


def details(t: Tables) -> DataFrame:
    v = F.col("value")
    restored = instant(micros("ts") + F.round(v * 600).cast("long") * 1_000_000)
    return t.events.where("event_type = 'error' AND value >= 10").select(
        F.col("user_id").alias("machine_id"),
        F.col("ts").alias("failure_time"),
        F.col("event_id").alias("asset_component_id"),
        F.pmod(F.floor(v), F.lit(5)).cast("int").alias("failure_mode_id"),
        severity(v * 10).alias("severity"),
        F.when(v <= 150, v < 20).alias("planned"),
        F.when(v <= 200, restored).alias("restored_at"),
        (v * 10).alias("downtime_minutes"),
    )


def maintenance(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'purchase'").select(F.col("user_id").alias("asset_id"), F.col("ts").alias("completed_at"))


def meters(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'signup'").select(
        F.col("event_id").alias("meter_reading_id"),
        F.col("user_id").alias("asset_id"),
        F.col("ts").alias("reading_time"),
        ((micros("ts") - F.lit(BASE_US)) / F.lit(3_600_000_000.0) + F.col("value")).alias("operating_hours"),
    )


def assets(t: Tables) -> DataFrame:
    bal = F.col("c_acctbal")
    start = ntz(datetime(2023, 6, 1))
    installed = F.when(bal >= 0, instant(micros(start) + F.floor(bal / 30) * F.lit(86_400_000_000)))
    return t.customer.select(
        F.col("c_custkey").alias("asset_id"),
        F.col("c_name").alias("asset_name"),
        F.col("c_nationkey").alias("site_id"),
        F.col("c_mktsegment").alias("asset_type_name"),
        F.pmod(F.col("c_nationkey"), F.lit(8)).alias("asset_type_id"),
        F.col("c_nationkey").alias("asset_model_id"),
        first_band([(bal < 1000, "low"), (bal < 4000, "medium"), (bal < 8000, "high")], "critical").alias("criticality"),
        installed.alias("installed_at"),
        F.when(bal <= 9000, F.coalesce(installed, start) + F.expr("INTERVAL 7 DAYS")).alias("commissioned_at"),
        F.when(bal.between(3000, 3500), ntz(datetime(2024, 1, 15))).alias("retired_at"),
    )


STATE_OF = {"click": "running", "signup": "running", "view": "idle", "purchase": "maintenance"}


def states(t: Tables) -> DataFrame:
    """Each event opens a state that lasts until the next event of the same asset."""
    e = t.events.select(F.col("event_id").alias("state_id"), F.col("user_id").alias("asset_id"), F.col("ts").alias("state_start"), "event_type")
    named = first_band([(F.col("event_type") == k, v) for k, v in STATE_OF.items()], "offline")
    chained = with_neighbours(e, ["asset_id"], "state_start", ["state_id"], following={"state_end": "state_start"}, cell="1 day")
    return chained.select("state_id", "asset_id", "state_start", "state_end", named.alias("operating_state"))


def loose_states(t: Tables) -> DataFrame:
    """Intervals with overlaps, gaps, open ends and empty ones, from the orders of a customer."""
    days = F.floor(F.col("o_totalprice") / 5000).cast("long") - 2
    end = F.when(F.col("o_totalprice") < 480_000, instant(micros("o_orderdate") + days * F.lit(86_400_000_000)))
    return t.orders.select(
        F.col("o_orderkey").alias("state_id"),
        F.col("o_custkey").alias("asset_id"),
        F.col("o_orderdate").alias("state_start"),
        end.alias("state_end"),
        F.col("o_orderpriority").alias("operating_state"),
    )


def predictions(t: Tables) -> DataFrame:
    p = F.round(F.pmod(F.col("value"), F.lit(100.0)) / 100, 4)
    feature = instant(micros("ts") - F.pmod(micros("ts"), F.lit(86_400_000_000)))
    return t.events.where("event_type = 'view'").select(
        F.col("event_id").alias("prediction_id"),
        F.col("user_id").alias("asset_id"),
        feature.alias("feature_time"),
        F.col("ts").alias("prediction_time"),
        F.when(F.col("value") < 100, F.col("ts")).alias("scored_at"),
        F.lit("failure_model").alias("model_name"),
        F.concat(F.lit("v"), F.pmod(F.floor("value"), F.lit(2)).cast("string")).alias("model_version"),
        F.lit(72).alias("forecast_horizon_hours"),
        p.alias("failure_probability"),
        F.lit(THRESHOLD).alias("threshold_used"),
        risk_level(p, F.lit(THRESHOLD)).alias("risk_level"),
    )


def components(t: Tables) -> DataFrame:
    """Installed parts: a shipped line is a component of its supplier's asset."""
    life = (F.col("l_quantity").cast("long") * 30) * F.lit(86_400_000_000)
    gone = F.col("l_returnflag") == "R"
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("asset_component_id"),
        F.col("l_suppkey").alias("asset_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_shipdate").alias("installed_at"),
        F.when(gone, instant(micros("l_shipdate") + life)).alias("removed_at"),
        (~gone | (F.col("l_linestatus") == "O")).alias("active"),
    )


def work_orders(t: Tables) -> DataFrame:
    day = F.lit(86_400_000_000)
    status = first_band([(F.col("o_orderstatus") == "F", "completed"), (F.col("o_orderstatus") == "P", "in_progress")], "open")
    done = instant(micros("o_orderdate") + (F.pmod(F.col("o_totalprice").cast("long"), F.lit(30)) + 1) * day)
    return t.orders.select(
        F.col("o_orderkey").alias("work_order_id"),
        F.col("o_custkey").alias("asset_id"),
        status.alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("opened_at"),
        instant(micros("o_orderdate") + day).alias("scheduled_at"),
        F.when(F.col("o_orderstatus") == "F", done).alias("completed_at"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("total_cost"),
    )


def usage(t: Tables) -> DataFrame:
    """Parts used by work orders; a zero discount stands for a missing price."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("work_order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice").cast("decimal(18,2)")).alias("line_cost"),
    )


SQL = {
    "telemetry": """SELECT user_id AS asset_id, ts AS event_time, event_id, value, value AS temperature,
        least(100.0::DOUBLE, value * 1.5) AS cpu_load, value * 3 AS network_latency,
        CAST(floor(value) AS INTEGER) % 25 AS hardware_configuration_id FROM events WHERE event_type <> 'error'""",
    "failures": "SELECT user_id AS machine_id, ts AS failure_time FROM events WHERE event_type = 'error'",
    "details": """SELECT user_id AS machine_id, ts AS failure_time, event_id AS asset_component_id,
        CAST(floor(value) AS INTEGER) % 5 AS failure_mode_id,
        CASE WHEN value * 10 > 1440 THEN 'critical' WHEN value * 10 > 240 THEN 'major' ELSE 'minor' END AS severity,
        CASE WHEN value <= 150 THEN value < 20 END AS planned,
        CASE WHEN value <= 200 THEN ts + to_seconds(CAST(round(value * 600) AS BIGINT)) END AS restored_at,
        value * 10 AS downtime_minutes FROM events WHERE event_type = 'error' AND value >= 10""",
    "maintenance": "SELECT user_id AS asset_id, ts AS completed_at FROM events WHERE event_type = 'purchase'",
    "meters": """SELECT event_id AS meter_reading_id, user_id AS asset_id, ts AS reading_time,
        (epoch_us(ts) - 1704067200000000) / 3600000000.0::DOUBLE + value AS operating_hours FROM events WHERE event_type = 'signup'""",
    "assets0": """SELECT c_custkey AS asset_id, c_name AS asset_name, c_nationkey AS site_id, c_mktsegment AS asset_type_name,
        c_nationkey % 8 AS asset_type_id, c_nationkey AS asset_model_id, c_acctbal AS bal,
        CASE WHEN c_acctbal < 1000 THEN 'low' WHEN c_acctbal < 4000 THEN 'medium' WHEN c_acctbal < 8000 THEN 'high' ELSE 'critical' END AS criticality,
        CASE WHEN c_acctbal >= 0 THEN TIMESTAMP '2023-06-01' + to_days(CAST(floor(c_acctbal / 30) AS INTEGER)) END AS installed_at,
        CASE WHEN c_acctbal BETWEEN 3000 AND 3500 THEN TIMESTAMP '2024-01-15' END AS retired_at FROM customer""",
    "assets": """SELECT *, CASE WHEN bal <= 9000 THEN coalesce(installed_at, TIMESTAMP '2023-06-01') + INTERVAL 7 DAYS END AS commissioned_at
        FROM assets0""",
    "states": """SELECT event_id AS state_id, user_id AS asset_id, ts AS state_start,
        lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS state_end,
        CASE event_type WHEN 'click' THEN 'running' WHEN 'signup' THEN 'running' WHEN 'view' THEN 'idle'
             WHEN 'purchase' THEN 'maintenance' ELSE 'offline' END AS operating_state FROM events""",
    "loose_states": """SELECT o_orderkey AS state_id, o_custkey AS asset_id, o_orderdate AS state_start,
        CASE WHEN o_totalprice < 480000 THEN o_orderdate + to_days(CAST(floor(o_totalprice / 5000) AS INTEGER) - 2) END AS state_end,
        o_orderpriority AS operating_state FROM orders""",
    "predictions": """SELECT event_id AS prediction_id, user_id AS asset_id, date_trunc('day', ts)::TIMESTAMP AS feature_time, ts AS prediction_time,
        CASE WHEN value < 100 THEN ts END AS scored_at, 'failure_model' AS model_name,
        'v' || CAST(CAST(floor(value) AS INTEGER) % 2 AS VARCHAR) AS model_version, 72 AS forecast_horizon_hours,
        round((value % 100) / 100, 4) AS failure_probability, 0.5::DOUBLE AS threshold_used,
        CASE WHEN round((value % 100) / 100, 4) >= 0.85 THEN 'critical' WHEN round((value % 100) / 100, 4) >= 0.5 THEN 'high'
             WHEN round((value % 100) / 100, 4) >= 0.25 THEN 'medium' ELSE 'low' END AS risk_level
        FROM events WHERE event_type = 'view'""",
    "components": """SELECT l_orderkey * 10 + l_linenumber AS asset_component_id, l_suppkey AS asset_id, l_partkey AS part_id,
        l_shipdate AS installed_at,
        CASE WHEN l_returnflag = 'R' THEN l_shipdate + to_days(CAST(l_quantity AS INTEGER) * 30) END AS removed_at,
        (l_returnflag <> 'R' OR l_linestatus = 'O') AS active FROM lineitem""",
    "work_orders": """SELECT o_orderkey AS work_order_id, o_custkey AS asset_id,
        CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'in_progress' ELSE 'open' END AS status,
        o_orderpriority AS priority, o_orderdate AS opened_at, o_orderdate + INTERVAL 1 DAY AS scheduled_at,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate + to_days(CAST(CAST(floor(o_totalprice) AS BIGINT) % 30 AS INTEGER) + 1) END AS completed_at,
        CAST(o_totalprice AS DECIMAL(18,2)) AS total_cost FROM orders""",
    "usage": """SELECT l_orderkey AS work_order_id, l_partkey AS part_id, CAST(l_quantity AS BIGINT) AS quantity,
        CASE WHEN l_discount > 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS line_cost FROM lineitem""",
}


def sql(roles: str, body: str, *extra: str) -> str:
    """``WITH`` the named roles and further CTE definitions, then ``body``."""
    names = roles.split()
    if "assets" in names and "assets0" not in names:
        names.insert(names.index("assets"), "assets0")
    ctes = [f"{n} AS ({SQL[n]})" for n in names] + list(extra)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
