"""Data quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.num import money
from ..operators import quality as q
from ..operators.temporal import interval_issues
from .registry import query
from .roles import assets, components, details, failures, loose_states, meters, sql, usage, work_orders


@query("n01_null_keys", "SELECT count(*) FILTER (WHERE k IS NULL OR ts IS NULL) AS null_key_rows, count(*) AS row_count FROM (SELECT CASE WHEN value < 1 THEN NULL ELSE user_id END AS k, ts FROM events)")
def n01(t):
    keyed = t.events.select(F.when(F.col("value") >= 1, F.col("user_id")).alias("k"), "ts")
    return q.null_keys(keyed, ["k", "ts"])


@query("n02_duplicate_composite_keys", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def n02(t):
    return q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("n02_duplicate_single_keys", "SELECT o_custkey, count(*) AS row_count FROM orders GROUP BY 1 HAVING count(*) > 1")
def n02b(t):
    return q.duplicate_keys(t.orders, ["o_custkey"])


@query("n03_orphans", "SELECT l_partkey, count(*) AS row_count FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10) GROUP BY 1")
def n03(t):
    return q.orphans(t.lineitem, t.part.where("p_size > 10"), "l_partkey", "p_partkey")


@query("n03_key_ranges", """SELECT rule, violations FROM (SELECT (SELECT count(*) FROM orders WHERE o_custkey NOT BETWEEN 0 AND 999) AS a, (SELECT count(*) FROM orders WHERE o_orderkey < 0) AS b),
    LATERAL (VALUES ('customer_in_range', a), ('order_not_negative', b)) v(rule, violations)""")
def n03b(t):
    return q.rule_report(t.orders, {"customer_in_range": F.col("o_custkey").between(0, 999), "order_not_negative": F.col("o_orderkey") >= 0})


@query("n05_interval_issues", sql("loose_states", """SELECT kind, count(*) AS issues FROM (SELECT 'invalid' AS kind FROM loose_states WHERE state_end <= state_start UNION ALL
    SELECT CASE WHEN r > state_start THEN 'overlap' ELSE 'gap' END FROM (SELECT *, max(e) OVER (PARTITION BY asset_id ORDER BY state_start, state_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM
      (SELECT *, coalesce(state_end, TIMESTAMP '9999-01-01') AS e FROM loose_states) WHERE e > state_start) WHERE r IS NOT NULL AND r <> state_start) GROUP BY 1"""))
def n05(t):
    return interval_issues(loose_states(t), ["asset_id"], "state_start", "state_end", "state_id").groupBy("kind").agg(F.count(F.lit(1)).alias("issues"))


@query("n05_meter_resets", sql("meters", "SELECT asset_id, count(*) AS resets FROM (SELECT asset_id, operating_hours, lag(operating_hours) OVER (PARTITION BY asset_id ORDER BY reading_time, meter_reading_id) AS p FROM meters) WHERE operating_hours < p GROUP BY 1"))
def n05b(t):
    from ..operators.temporal import with_neighbours

    chained = with_neighbours(meters(t), ["asset_id"], "reading_time", ["meter_reading_id"], {"p": "operating_hours"})
    return chained.where("operating_hours < p").groupBy("asset_id").agg(F.count(F.lit(1)).alias("resets"))


@query("n06_ownership", """SELECT count(*) AS lines, count(*) FILTER (WHERE s_nationkey <> c_nationkey) AS other_nation, count(*) FILTER (WHERE s_nationkey IS NULL OR c_nationkey IS NULL) AS unknown FROM lineitem
    LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey""")
def n06(t):
    """Where a line names one owner through its supplier and another through its order."""
    # lines shrink to (order, supplier) before the large join
    pairs = t.lineitem.groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"))
    both = (
        pairs.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left")
    )
    a, b, n = F.col("s_nationkey"), F.col("c_nationkey"), F.col("n")
    zero = F.lit(0)
    return both.agg(
        F.sum("n").alias("lines"),
        F.coalesce(F.sum(F.when(a != b, n)), zero).alias("other_nation"),
        F.coalesce(F.sum(F.when(a.isNull() | b.isNull(), n)), zero).alias("unknown"),
    )


@query("n06_models_of_several_types", sql("assets", "SELECT asset_model_id, count(DISTINCT asset_type_name) AS types, count(*) AS assets FROM assets GROUP BY 1 HAVING count(DISTINCT asset_type_name) > 1"))
def n06b(t):
    """A model belongs to one type."""
    per_type = assets(t).groupBy("asset_model_id", "asset_type_name").agg(F.count(F.lit(1)).alias("n"))
    return per_type.groupBy("asset_model_id").agg(F.count("asset_type_name").alias("types"), F.sum("n").alias("assets")).where("types > 1")


@query("n06_modes_of_several_types", sql("details assets", """SELECT failure_mode_id, count(DISTINCT asset_type_name) AS types, count(*) AS failures FROM details LEFT JOIN assets ON asset_id = machine_id
    GROUP BY 1 HAVING count(DISTINCT asset_type_name) > 1"""))
def n06c(t):
    """A failure mode belongs to one type of asset."""
    per_asset = details(t).groupBy("failure_mode_id", "machine_id").agg(F.count(F.lit(1)).alias("n"))
    named = per_asset.join(assets(t).select(F.col("asset_id").alias("machine_id"), "asset_type_name"), "machine_id", "left")
    per_type = named.groupBy("failure_mode_id", "asset_type_name").agg(F.sum("n").alias("n"))
    return per_type.groupBy("failure_mode_id").agg(F.count("asset_type_name").alias("types"), F.sum("n").alias("failures")).where("types > 1")


@query("n06_components_of_other_assets", sql("details components", """SELECT count(*) AS failures, count(*) FILTER (WHERE asset_id <> machine_id) AS other_asset, count(*) FILTER (WHERE asset_id IS NULL) AS unknown_component
    FROM details LEFT JOIN components USING (asset_component_id)"""))
def n06d(t):
    """A failure names a component of the asset that failed."""
    both = details(t).join(components(t).select("asset_component_id", "asset_id"), "asset_component_id", "left")
    return both.agg(
        F.count(F.lit(1)).alias("failures"), F.count_if(F.col("asset_id") != F.col("machine_id")).alias("other_asset"), F.count_if(F.col("asset_id").isNull()).alias("unknown_component")
    )


@query("n07_constraints", """SELECT rule, violations FROM (SELECT count(*) FILTER (WHERE NOT (l_quantity > 0)) AS a, count(*) FILTER (WHERE NOT (l_discount > 0)) AS b, count(*) FILTER (WHERE l_shipdate IS NULL) AS c,
    (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS d, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) AS e FROM lineitem),
    LATERAL (VALUES ('quantity_positive', a), ('discount_positive', b), ('shipdate_present', c), ('order_exists', d), ('line_unique', e)) v(rule, violations)""")
def n07(t):
    rows = q.rule_report(
        t.lineitem, {"quantity_positive": F.col("l_quantity") > 0, "discount_positive": F.col("l_discount") > 0, "shipdate_present": F.col("l_shipdate").isNotNull()}
    )
    lost = q.orphans(t.lineitem, t.orders, "l_orderkey", "o_orderkey").agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("violations"))
    twice = q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).agg(F.count(F.lit(1)).alias("violations"))
    return rows.unionByName(lost.select(F.lit("order_exists").alias("rule"), "violations")).unionByName(twice.select(F.lit("line_unique").alias("rule"), "violations"))


VERSIONS = "v AS (SELECT o_custkey AS business_key, o_orderkey AS version_key, o_orderdate AS effective_from, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(CAST(floor(o_totalprice / 2000) AS INTEGER)) END AS effective_to, o_orderstatus = 'O' AS is_current FROM orders)"


def versions(t):
    from ..functions.when import instant, micros

    end = instant(micros("o_orderdate") + F.floor(F.col("o_totalprice") / 2000) * F.lit(86_400_000_000))
    live = F.col("o_orderstatus") == "O"
    return t.orders.select(
        F.col("o_custkey").alias("business_key"), F.col("o_orderkey").alias("version_key"), F.col("o_orderdate").alias("effective_from"), F.when(~live, end).alias("effective_to"), live.alias("is_current")
    )


@query("n08_current_versions", f"WITH {VERSIONS} SELECT business_key, count(*) FILTER (WHERE is_current) AS current_rows, count(*) AS versions FROM v GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1")
def n08(t):
    return q.version_issues(versions(t), "business_key", "is_current")


@query("n08_overlapping_versions", f"""WITH {VERSIONS} SELECT business_key, count(*) AS overlaps FROM (SELECT *, max(e) OVER (PARTITION BY business_key ORDER BY effective_from, version_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM
    (SELECT *, coalesce(effective_to, TIMESTAMP '9999-01-01') AS e FROM v) WHERE e > effective_from) WHERE r > effective_from GROUP BY 1""")
def n08b(t):
    found = interval_issues(versions(t), ["business_key"], "effective_from", "effective_to", "version_key")
    return found.where("kind = 'overlap'").groupBy("business_key").agg(F.count(F.lit(1)).alias("overlaps"))


@query("n10_failure_reconciliation", sql("failures details", """SELECT (SELECT count(*) FROM failures) AS raw_rows, (SELECT count(*) FROM (SELECT DISTINCT machine_id, failure_time FROM failures)) AS distinct_events,
    (SELECT count(*) FROM details) AS detail_rows, (SELECT count(*) FROM details d WHERE NOT EXISTS (SELECT 1 FROM failures f WHERE f.machine_id = d.machine_id AND f.failure_time = d.failure_time)) AS details_without_event"""))
def n10(t):
    key = ["machine_id", "failure_time"]
    raw = failures(t).groupBy(*key).agg(F.count(F.lit(1)).alias("r"))
    more = details(t).groupBy(*key).agg(F.count(F.lit(1)).alias("d"))
    both = raw.join(more, key, "full")
    zero = F.lit(0)
    return both.agg(
        F.coalesce(F.sum("r"), zero).alias("raw_rows"),
        F.count("r").alias("distinct_events"),
        F.coalesce(F.sum("d"), zero).alias("detail_rows"),
        F.coalesce(F.sum(F.when(F.col("r").isNull(), F.col("d"))), zero).alias("details_without_event"),
    )


@query("n10_spend_and_usage", sql("work_orders usage", """SELECT (SELECT CAST(sum(total_cost) AS DECIMAL(18,2)) FROM work_orders) AS order_spend, (SELECT CAST(sum(line_cost) AS DECIMAL(18,2)) FROM usage) AS material_cost,
    (SELECT count(*) FROM work_orders) AS orders, (SELECT count(*) FROM usage) AS usage_lines"""))
def n10b(t):
    """Both totals come from their own source; joining the two would repeat order costs per line."""
    spend = work_orders(t).agg(money(F.sum("total_cost")).alias("order_spend"), F.count(F.lit(1)).alias("orders"))
    used = usage(t).agg(money(F.sum("line_cost")).alias("material_cost"), F.count(F.lit(1)).alias("usage_lines"))
    return spend.withColumns({c: used.select(c).scalar() for c in used.columns})


@query("n06_component_flags", sql("components", "SELECT count(*) AS components, count(*) FILTER (WHERE removed_at IS NOT NULL AND active) AS removed_but_active, count(*) FILTER (WHERE removed_at < installed_at) AS removed_before_installed FROM components"))
def n06b(t):
    return components(t).agg(
        F.count(F.lit(1)).alias("components"),
        F.count_if(F.col("removed_at").isNotNull() & F.col("active")).alias("removed_but_active"),
        F.count_if(F.col("removed_at") < F.col("installed_at")).alias("removed_before_installed"),
    )
