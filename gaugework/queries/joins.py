"""Join inventory: equi, enrichment, semi, anti, as-of, range, interval and hierarchy joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.num import money, r6
from ..functions.when import hours, micros
from ..operators.joins import Dimension, ancestors, fan_out, having_any, having_none, roots, star
from ..operators.temporal import as_of_latest, clip, count_in_window, first_after, interval_issues, stab, time_to_next
from .registry import query
from .roles import details, failures, loose_states, maintenance, meters, ntz, predictions, sql, telemetry


@query("d01_star_join", """SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def d01(t):
    # orders shrink to (customer, year) first; the chain of lookups then runs on that
    per_customer = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("v")
    )
    return (
        per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "order_year")
        .agg(F.sum("n").alias("orders"), money(F.sum("v")).alias("total"))
    )


@query("d02_left_enrichment", "SELECT o_orderkey, o_orderstatus, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 5000")
def d02(t):
    rich = t.customer.where("c_acctbal > 5000").select("c_custkey", "c_name", "c_mktsegment")
    return t.orders.join(rich, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_orderstatus", "c_name", "c_mktsegment")


@query("d03_composite_left_join", sql("failures details", """SELECT f.machine_id, f.failure_time, coalesce(severity, 'Unclassified') AS severity FROM failures f
    LEFT JOIN details d ON d.machine_id = f.machine_id AND d.failure_time = f.failure_time"""))
def d03(t):
    both = failures(t).join(details(t), ["machine_id", "failure_time"], "left")
    return both.select("machine_id", "failure_time", F.coalesce("severity", F.lit("Unclassified")).alias("severity"))


@query("d04_left_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)")
def d04(t):
    return having_none(t.customer, t.orders.where("o_totalprice > 450000"), "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("d05_installed_part_filter", "SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey = s_suppkey AND p_brand = 'Brand#7' AND p_size > 40)")
def d05(t):
    wanted = t.part.where("p_brand = 'Brand#7' AND p_size > 40").select("p_partkey")
    holding = t.lineitem.select("l_suppkey", "l_partkey").join(wanted, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    return having_any(t.supplier, holding, "s_suppkey", "l_suppkey").select("s_suppkey", "s_name")


@query("d06_small_schedule_join", sql("failures", "SELECT e.event_id, e.user_id, s.failures, s.first_failure FROM events e LEFT JOIN (SELECT machine_id, count(*) AS failures, min(failure_time) AS first_failure FROM failures GROUP BY 1) s ON s.machine_id = e.user_id"))
def d06(t):
    schedule = failures(t).groupBy("machine_id").agg(F.count(F.lit(1)).alias("failures"), F.min("failure_time").alias("first_failure"))
    return t.events.select("event_id", "user_id").join(schedule, F.col("user_id") == F.col("machine_id"), "left").drop("machine_id")


@query("d07_year_spine", "SELECT c_custkey AS employee_key, c_nationkey AS entity_key, CAST(y AS INTEGER) AS tax_year, CAST(y AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR) AS return_id FROM customer, range(2021, 2026) r(y)")
def d07(t):
    """One row per customer and tax year: a narrow explode of a fixed list of years."""
    years = F.explode(F.sequence(F.lit(2021), F.lit(2025)))
    spine = t.customer.select(F.col("c_custkey").alias("employee_key"), F.col("c_nationkey").alias("entity_key"), years.alias("tax_year"))
    return spine.withColumn("return_id", F.concat_ws("-", F.col("tax_year").cast("string"), F.col("employee_key").cast("string")))


@query("d08_as_of_meter", sql("telemetry meters", """SELECT event_id, t.asset_id, event_time, round((SELECT arg_max(operating_hours, (reading_time, meter_reading_id)) FROM meters m
    WHERE m.asset_id = t.asset_id AND m.reading_time <= t.event_time), 6) AS operating_hours FROM telemetry t"""))
def d08(t):
    left = telemetry(t).select("event_id", "asset_id", "event_time")
    out = as_of_latest(left, meters(t), "asset_id", "event_time", "reading_time", ["operating_hours"], tie=["meter_reading_id"])
    return out.withColumn("operating_hours", r6("operating_hours"))


@query("d09_hours_since_maintenance", sql("telemetry maintenance", """SELECT event_id, last_done, round((epoch_us(event_time) - epoch_us(last_done)) / 3600000000.0::DOUBLE, 6) AS hours_since_maintenance FROM
    (SELECT event_id, event_time, (SELECT max(completed_at) FROM maintenance m WHERE m.asset_id = t.asset_id AND m.completed_at <= t.event_time) AS last_done FROM telemetry t)"""))
def d09(t):
    left = telemetry(t).select("event_id", "asset_id", "event_time")
    out = as_of_latest(left, maintenance(t), "asset_id", "event_time", "completed_at", matched="last_done")
    return out.select("event_id", "last_done", r6(hours(micros("event_time") - micros("last_done"))).alias("hours_since_maintenance"))


@query("d10_failures_in_window", sql("telemetry failures", """SELECT event_id, (SELECT count(*) FROM failures f WHERE f.machine_id = t.asset_id AND f.failure_time < t.event_time
    AND f.failure_time >= t.event_time - INTERVAL 7 DAYS) AS failures FROM telemetry t"""))
def d10(t):
    left = telemetry(t).select("event_id", "asset_id", "event_time")
    return count_in_window(left, failures(t), [("asset_id", "machine_id")], "event_time", "failure_time", "7 days", "failures").select("event_id", "failures")


@query("d11_next_failure", sql("telemetry failures", """SELECT event_id, (SELECT min(failure_time) FROM failures f WHERE f.machine_id = t.asset_id AND f.failure_time > t.event_time
    AND f.failure_time <= t.event_time + INTERVAL 72 HOURS) AS next_failure FROM telemetry t"""))
def d11(t):
    left = telemetry(t).select("event_id", "asset_id", "event_time")
    return first_after(left, failures(t), [("asset_id", "machine_id")], "event_time", "failure_time", "72 hours", name="next_failure").select("event_id", "next_failure")


@query("d12_time_to_next_failure", sql("telemetry failures", """SELECT event_id, round((epoch_us(n) - epoch_us(event_time)) / 1000000.0::DOUBLE, 6) AS seconds_to_failure FROM (SELECT event_id, event_time,
    (SELECT min(failure_time) FROM failures f WHERE f.machine_id = t.asset_id AND f.failure_time >= t.event_time AND f.failure_time <= t.event_time + INTERVAL 72 HOURS) AS n FROM telemetry t)"""))
def d12(t):
    left = telemetry(t).select("event_id", "asset_id", "event_time")
    out = time_to_next(left, failures(t), [("asset_id", "machine_id")], "event_time", "failure_time", "72 hours", "seconds_to_failure")
    return out.select("event_id", r6("seconds_to_failure").alias("seconds_to_failure"))


@query("d13_interval_stab", sql("loose_states", """SELECT o_orderkey, coalesce((SELECT arg_max(operating_state, (coalesce(state_end, TIMESTAMP '9999-01-01'), state_start, state_id)) FROM loose_states s
      WHERE s.asset_id = o_custkey AND state_start <= q AND (state_end IS NULL OR state_end > q) AND (state_end IS NULL OR state_end > state_start)), 'Unknown') AS operating_state,
    (SELECT count(*) FROM loose_states s WHERE s.asset_id = o_custkey AND state_start <= q AND (state_end IS NULL OR state_end > q) AND (state_end IS NULL OR state_end > state_start)) AS covering
    FROM (SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 45 DAYS AS q FROM orders)"""))
def d13(t):
    asks = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderdate") + F.expr("INTERVAL 45 DAYS")).alias("at"))
    out = stab(
        asks, loose_states(t), [("o_custkey", "asset_id")], "at", "state_start", "state_end", {"operating_state": "operating_state"}, ["state_id"],
        {"operating_state": "Unknown"}, "covering",
    )
    return out.select("o_orderkey", "operating_state", "covering")


@query("d14_interval_clip", sql("loose_states", """SELECT state_id, asset_id, greatest(state_start, TIMESTAMP '1998-01-01') AS clipped_start, least(coalesce(state_end, TIMESTAMP '1999-01-01'), TIMESTAMP '1999-01-01') AS clipped_end,
    round((epoch_us(least(coalesce(state_end, TIMESTAMP '1999-01-01'), TIMESTAMP '1999-01-01')) - epoch_us(greatest(state_start, TIMESTAMP '1998-01-01'))) / 3600000000.0::DOUBLE, 6) AS hours FROM loose_states
    WHERE least(coalesce(state_end, TIMESTAMP '1999-01-01'), TIMESTAMP '1999-01-01') > greatest(state_start, TIMESTAMP '1998-01-01')"""))
def d14(t):
    out = clip(loose_states(t), "state_start", "state_end", ntz(datetime(1998, 1, 1)), ntz(datetime(1999, 1, 1)))
    return out.select("state_id", "asset_id", "clipped_start", "clipped_end", r6("hours").alias("hours"))


@query("d15_ancestors", """WITH RECURSIVE up AS (SELECT c_custkey AS id, CAST(floor(c_custkey / 10) AS BIGINT) AS parent FROM customer WHERE c_custkey > 0),
    a AS (SELECT id AS node, parent AS ancestor, 1 AS depth FROM up UNION ALL SELECT node, parent, depth + 1 FROM a JOIN up ON ancestor = id) SELECT node, ancestor, depth FROM a""")
def d15(t):
    """Ten assets share a parent asset; every ancestor of every asset with its distance."""
    tree = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 10)).alias("parent"))
    return ancestors(tree, "id", "parent")


@query("d15_roots", """WITH RECURSIVE up AS (SELECT c_custkey AS id, CASE WHEN c_custkey > 0 THEN CAST(floor(c_custkey / 3) AS BIGINT) END AS parent FROM customer),
    a AS (SELECT id AS node, id AS root, CAST(0 AS BIGINT) AS depth FROM up UNION ALL SELECT node, parent, depth + 1 FROM a JOIN up ON root = id WHERE parent IS NOT NULL)
    SELECT node, arg_max(root, depth) AS root, max(depth) AS depth FROM a GROUP BY 1""")
def d15c(t):
    """The topmost asset above each one, and its distance."""
    tree = t.customer.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") > 0, F.floor(F.col("c_custkey") / 3)).alias("parent"))
    return roots(tree, "id", "parent")


@query("d15_children", """SELECT CAST(floor(c_custkey / 10) AS BIGINT) AS parent_asset_id, count(*) AS children, CAST(sum(coalesce(n, 0)) AS BIGINT) AS child_orders FROM customer
    LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE c_custkey > 0 GROUP BY 1""")
def d15b(t):
    """Children per parent; their facts are counted before the join, so nothing is multiplied."""
    n = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    kids = t.customer.where("c_custkey > 0").join(n, F.col("o_custkey") == F.col("c_custkey"), "left")
    return kids.groupBy(F.floor(F.col("c_custkey") / 10).alias("parent_asset_id")).agg(
        F.count(F.lit(1)).alias("children"), F.sum(F.coalesce("n", F.lit(0))).alias("child_orders")
    )


ISSUES_SQL = sql("loose_states", """SELECT asset_id, 'invalid' AS kind, state_start AS issue_start, state_end AS issue_end FROM loose_states WHERE state_end <= state_start
    UNION ALL SELECT asset_id, CASE WHEN r > state_start THEN 'overlap' ELSE 'gap' END, least(r, state_start), CASE WHEN r > state_start THEN nullif(least(r, e), TIMESTAMP '9999-01-01') ELSE state_start END
    FROM (SELECT *, max(e) OVER (PARTITION BY asset_id ORDER BY state_start, state_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM
      (SELECT *, coalesce(state_end, TIMESTAMP '9999-01-01') AS e FROM loose_states) WHERE e > state_start) WHERE r IS NOT NULL AND r <> state_start""")


@query("d16_interval_issues", ISSUES_SQL)
def d16(t):
    return interval_issues(loose_states(t), ["asset_id"], "state_start", "state_end", "state_id")


@query("d17_outcome_join", sql("predictions failures", """SELECT prediction_id, (SELECT min(failure_time) FROM failures f WHERE f.machine_id = p.asset_id AND f.failure_time > p.prediction_time AND f.failure_time <= p.prediction_time + INTERVAL 72 HOURS) AS actual_failure_time FROM predictions p"""))
def d17(t):
    from ..plans.monitoring import with_horizon_end

    out = first_after(
        with_horizon_end(predictions(t)), failures(t), [("asset_id", "machine_id")], "prediction_time", "failure_time", horizon_end="horizon_end",
        name="actual_failure_time",
    )
    return out.select("prediction_id", "actual_failure_time")


@query("d18_state_share_split", """WITH s AS (SELECT o_orderkey, c_nationkey AS home, CAST(floor(o_totalprice) AS BIGINT) % 25 AS work, o_totalprice < 150000 AS second FROM orders JOIN customer ON o_custkey = c_custkey),
    r AS (SELECT o_orderkey, home AS state_key, CASE WHEN second AND work <> home THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS share FROM s UNION ALL SELECT o_orderkey, CAST(work AS INTEGER), 0.3::DOUBLE FROM s WHERE second AND work <> home)
    SELECT o_orderkey, n_name, round(share, 6) AS share FROM r JOIN nation ON n_nationkey = state_key""")
def d18(t):
    from ..plans.taxes import state_filings

    spine = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("c_nationkey").alias("home_state_key"),
        F.pmod(F.floor("o_totalprice"), F.lit(25)).cast("int").alias("work_state_key"),
        (F.col("o_totalprice") < 150_000).alias("has_second_state"),
    )
    named = state_filings(spine).join(t.nation, F.col("state_key") == F.col("n_nationkey"))
    return named.select("o_orderkey", "n_name", r6("share").alias("share"))


def order_star(t):
    return {
        "customer": Dimension(t.customer, "c_custkey", "o_custkey", {"c_mktsegment": "c_mktsegment", "c_nationkey": "c_nationkey"}),
        "nation": Dimension(t.nation, "n_nationkey", "c_nationkey", {"n_name": "n_name"}, via="customer"),
    }


@query("d19_unused_dimension_drop", "SELECT o_orderkey, o_totalprice, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def d19(t):
    """Only the customer lookup is joined; the nation lookup is not asked for."""
    return star(t.orders, order_star(t), ["o_orderkey", "o_totalprice", "c_mktsegment"])


@query("d19_chained_dimensions", "SELECT o_orderkey, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def d19b(t):
    return star(t.orders, order_star(t), ["o_orderkey", "n_name"])


@query("n11_fan_out_guard", """WITH l AS (SELECT count(*) AS left_rows FROM orders), j AS (SELECT count(*) AS joined_rows FROM orders LEFT JOIN (SELECT l_orderkey FROM lineitem) ON l_orderkey = o_orderkey)
    SELECT left_rows, joined_rows, left_rows = joined_rows AS keeps_grain FROM l, j""")
def n11(t):
    return fan_out(t.orders.select(F.col("o_orderkey").alias("k")), t.lineitem.select(F.col("l_orderkey").alias("k")), ["k"])
