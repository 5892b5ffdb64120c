"""Calendar and clock tables, key and band expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import as_columns, clock_attributes, date_attributes, date_dim, time_dim
from ..functions.classes import severity
from ..functions.keys import bounded_key, moment_after, pick
from ..functions.num import r6
from ..operators.features import degradation
from ..operators.temporal import time_to_next
from ..sources import tax_tables as tax
from .registry import query
from .roles import failures, sql, telemetry

# Service tiers, first instant and seconds of the history.
TIERS = ("standard", "premium", "critical")
HISTORY_START, HISTORY_SECONDS = 1_672_531_200, 1_095 * 86_400
LATENCY_RISE = 300.0


@query("b02_bounded_key", "SELECT l_orderkey % 25 + 1 AS bucket, count(*) AS row_count FROM lineitem GROUP BY 1")
def b02(t):
    return t.lineitem.groupBy(bounded_key("l_orderkey", 25).alias("bucket")).agg(F.count(F.lit(1)).alias("row_count"))


@query("b03_pick", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'standard' WHEN 1 THEN 'premium' ELSE 'critical' END AS tier FROM orders")
def b03(t):
    return t.orders.select("o_orderkey", pick(TIERS, "o_orderkey").alias("tier"))


@query("b04_hashed_timestamp", "SELECT o_orderkey, TIMESTAMP '2023-01-01' + to_seconds((o_orderkey * 7919) % 94608000) AS moment FROM orders")
def b04(t):
    moment = moment_after(HISTORY_START, F.pmod(F.col("o_orderkey") * 7919, F.lit(HISTORY_SECONDS)))
    return t.orders.select("o_orderkey", moment.cast("timestamp_ntz").alias("moment"))


DATE_SQL = """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), n AS (SELECT d, date_diff('day', DATE '2000-01-01', d) AS k FROM d)
    SELECT k + 1 AS d_date_sk, strftime(d, '%Y%m%d') AS d_date_id, d AS d_date, CAST(year(d) * 12 + month(d) AS INTEGER) AS d_month_seq, CAST(weekofyear(d) AS INTEGER) AS d_week_seq, CAST(year(d) * 4 + quarter(d) AS INTEGER) AS d_quarter_seq,
    CAST(year(d) AS INTEGER) AS d_year, CAST(dayofweek(d) AS SMALLINT) AS d_dow, CAST(month(d) AS SMALLINT) AS d_moy, CAST(day(d) AS SMALLINT) AS d_dom, CAST(quarter(d) AS SMALLINT) AS d_qoy, CAST(year(d) AS INTEGER) AS d_fy_year,
    CAST(year(d) * 4 + quarter(d) AS INTEGER) AS d_fy_quarter_seq, CAST(weekofyear(d) AS INTEGER) AS d_fy_week_seq, dayname(d) AS d_day_name, 'Q' || CAST(quarter(d) AS VARCHAR) AS d_quarter_name, false AS d_holiday, dayofweek(d) IN (0, 6) AS d_weekend,
    false AS d_following_holiday, 1 AS d_first_dom, CAST(day(last_day(d)) AS INTEGER) AS d_last_dom, CAST(CASE WHEN k >= 364 THEN k + 1 - 364 END AS INTEGER) AS d_same_day_ly, CAST(CASE WHEN k >= 90 THEN k + 1 - 90 END AS INTEGER) AS d_same_day_lq,
    false AS d_current_day, false AS d_current_week, false AS d_current_month, false AS d_current_quarter, false AS d_current_year FROM n"""


@query("b07_date_dim", DATE_SQL)
def b07(t):
    return date_dim(t.orders.select(F.to_date("o_orderdate").alias("d_date")).distinct())


@query("b07_orders_by_calendar", "SELECT CAST(year(o_orderdate) AS INTEGER) AS d_year, 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS d_quarter_name, dayofweek(o_orderdate) IN (0, 6) AS d_weekend, count(*) AS orders FROM orders GROUP BY 1, 2, 3")
def b07b(t):
    a = date_attributes(F.to_date("o_orderdate"))
    wanted = {k: a[k] for k in ("d_year", "d_quarter_name", "d_weekend")}
    return t.orders.groupBy(*as_columns(wanted)).agg(F.count(F.lit(1)).alias("orders"))


@query("b08_time_dim", """WITH s AS (SELECT DISTINCT CAST(hour(ts) * 3600 + minute(ts) * 60 + floor(second(ts)) AS BIGINT) AS s FROM events)
    SELECT s + 1 AS t_time_sk, lpad(CAST(s AS VARCHAR), 6, '0') AS t_time_id, CAST(s AS INTEGER) AS t_time, CAST(s // 3600 AS SMALLINT) AS t_hour, CAST(s % 3600 // 60 AS SMALLINT) AS t_minute, CAST(s % 60 AS SMALLINT) AS t_second,
    CASE WHEN s < 43200 THEN 'AM' ELSE 'PM' END AS t_am_pm, CASE WHEN s < 28800 THEN 'night' WHEN s < 57600 THEN 'day' ELSE 'evening' END AS t_shift, 'standard' AS t_sub_shift,
    CASE WHEN s // 3600 BETWEEN 6 AND 10 THEN 'breakfast' WHEN s // 3600 BETWEEN 11 AND 14 THEN 'lunch' ELSE 'other' END AS t_meal_time FROM s""")
def b08(t):
    sec = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("long")
    return time_dim(t.events.select(sec.alias("second")).distinct())


@query("b08_events_by_meal", "SELECT CASE WHEN hour(ts) BETWEEN 6 AND 10 THEN 'breakfast' WHEN hour(ts) BETWEEN 11 AND 14 THEN 'lunch' ELSE 'other' END AS t_meal_time, count(*) AS events FROM events GROUP BY 1")
def b08b(t):
    sec = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    return t.events.groupBy(clock_attributes(sec)["t_meal_time"].alias("t_meal_time")).agg(F.count(F.lit(1)).alias("events"))


@query("b13_severity_rule", "SELECT CASE WHEN v > 1440 THEN 'critical' WHEN v > 240 THEN 'major' ELSE 'minor' END AS severity, count(*) AS failures FROM (SELECT l_extendedprice / 30 AS v FROM lineitem) GROUP BY 1")
def b13(t):
    return t.lineitem.groupBy(severity(F.col("l_extendedprice") / 30).alias("severity")).agg(F.count(F.lit(1)).alias("failures"))


@query("b17_fleet_expansion", "SELECT greatest(100, (SELECT max(user_id) FROM events), (SELECT max(o_custkey) FROM orders)) AS asset_count")
def b17(t):
    top = t.events.agg(F.max("user_id").alias("m")).unionByName(t.orders.agg(F.max("o_custkey").alias("m")))
    return top.agg(F.greatest(F.lit(100).cast("long"), F.max("m")).alias("asset_count"))


@query("b20_degradation", sql("telemetry failures", """SELECT event_id, round(d, 6) AS degradation, round(CASE WHEN d > 0 AND event_id % 3 = 0 THEN d * 15 ELSE 0 END, 6) AS surge, round(d * d * 300, 6) AS latency_rise FROM
    (SELECT event_id, coalesce(1 - (epoch_us(n) - epoch_us(event_time)) / 1000000.0::DOUBLE / 259200, 0) AS d FROM (SELECT event_id, event_time,
    (SELECT min(failure_time) FROM failures f WHERE f.machine_id = t.asset_id AND f.failure_time >= t.event_time AND f.failure_time <= t.event_time + INTERVAL 72 HOURS) AS n FROM telemetry t))"""))
def b20(t):
    left = telemetry(t).select("event_id", "asset_id", "event_time")
    near = time_to_next(left, failures(t), [("asset_id", "machine_id")], "event_time", "failure_time", "72 hours", "ahead")
    out = near.withColumns(degradation(F.col("ahead"), F.col("event_id")))
    d = F.col("degradation")
    return out.select("event_id", r6(d).alias("degradation"), r6("surge").alias("surge"), r6(d * d * LATENCY_RISE).alias("latency_rise"))


@query("b21_customers_by_state", f"""WITH s AS (SELECT generate_subscripts(l, 1) AS k, unnest(l) AS c FROM (SELECT string_split('{" ".join(tax.STATE_CODES)}', ' ') AS l))
    SELECT c AS state_code, c NOT IN ({", ".join(repr(c) for c in tax.UNTAXED_STATES)}) AS has_income_tax, c IN ({", ".join(repr(c) for c in tax.TERRITORIES)}) AS is_territory, count(*) AS customers
    FROM customer JOIN s ON k = c_custkey % 55 + 1 GROUP BY 1, 2, 3""")
def b21b(t):
    n = t.customer.groupBy(bounded_key("c_custkey", len(tax.STATE_CODES)).cast("int").alias("state_key")).agg(F.count(F.lit(1)).alias("customers"))
    return n.join(tax.dim_state(t.spark), "state_key").select("state_code", "has_income_tax", "is_territory", "customers")
