"""Aggregation, window, sort and set inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.num import money, r6
from ..operators.aggregates import capped_per_group, change_from_previous, ratio_of_sums, share_of_total, top_k
from ..operators.features import Metric, tumbling_features
from ..operators.latest import latest_conflicts, latest_per_key, latest_with_ties
from ..operators.quality import duplicate_keys
from ..operators.ranking import score_curve
from ..operators.temporal import interval_issues, with_neighbours
from .registry import query
from .roles import METRICS, failures, meters, predictions, sql, states, telemetry

VALUE = Metric("value", "value", ("mean", "stddev", "min", "max", "p95", "slope", "spike_count"), 70.0)
ROUND = ["value_mean", "value_stddev", "value_slope"]


@query("e01_tumbling_features", sql("telemetry", """SELECT asset_id, time_bucket(INTERVAL '24 hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
    time_bucket(INTERVAL '24 hours', event_time, TIMESTAMP '1970-01-01') + INTERVAL 24 HOURS AS window_end, count(*) AS telemetry_count, round(avg(value), 6) AS value_mean,
    round(stddev_samp(value), 6) AS value_stddev, min(value) AS value_min, max(value) AS value_max, quantile_disc(value, 0.95) AS value_p95,
    round((arg_max(value, event_time) - arg_min(value, event_time)) / 24, 6) + 0 AS value_slope, count(*) FILTER (WHERE value > 70) AS value_spike_count,
    arg_max(hardware_configuration_id, event_time) AS hardware_configuration_id FROM telemetry GROUP BY 1, 2, 3"""))
def e01(t):
    out = tumbling_features(telemetry(t), ["asset_id"], "event_time", [VALUE], "24 hours", ["event_id"], ["hardware_configuration_id"])
    return out.withColumns({c: r6(c) for c in ROUND})


@query("e02_window_slope", sql("telemetry", """SELECT asset_id, time_bucket(INTERVAL '6 hours', event_time, TIMESTAMP '1970-01-01') AS window_start,
    round((arg_max(value, event_time) - arg_min(value, event_time)) / 6, 6) + 0 AS value_slope FROM telemetry GROUP BY 1, 2"""))
def e02(t):
    out = tumbling_features(telemetry(t), ["asset_id"], "event_time", [Metric("value", "value", ("slope",))], "6 hours", ["event_id"])
    return out.select("asset_id", "window_start", r6("value_slope").alias("value_slope"))


@query("e03_percentile", "SELECT user_id, event_type, quantile_disc(value, 0.95) AS p95 FROM events GROUP BY 1, 2")
def e03(t):
    return t.events.groupBy("user_id", "event_type").agg(F.percentile_approx("value", 0.95, 10_000).alias("p95"))


@query("e04_sample_stddev", "SELECT user_id, date_trunc('day', ts)::DATE AS day, count(*) AS n, round(stddev_samp(value), 6) AS sd FROM events GROUP BY 1, 2")
def e04(t):
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), r6(F.stddev_samp("value")).alias("sd"))


@query("e05_spike_counts", sql("telemetry", """SELECT asset_id, count(*) FILTER (WHERE temperature > 70) AS temperature_spike_count, count(*) FILTER (WHERE cpu_load > 90) AS cpu_spike_count,
    count(*) FILTER (WHERE network_latency > 150) AS latency_spike_count FROM telemetry GROUP BY 1"""))
def e05(t):
    return telemetry(t).groupBy("asset_id").agg(*[F.count_if(F.col(m.column) > m.spike_above).alias(f"{m.name}_spike_count") for m in METRICS])


@query("e06_first_and_latest_value", "SELECT user_id, arg_min(value, (ts, event_id)) AS first_value, arg_max(value, (ts, event_id)) AS last_value, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY 1")
def e06(t):
    order = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(
        F.min_by("value", order).alias("first_value"), F.max_by("value", order).alias("last_value"), F.max_by("event_type", order).alias("last_type")
    )


@query("e07_group_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS orders FROM orders GROUP BY 1, 2 ORDER BY 1, 2")
def e07(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("orders")).orderBy("o_orderstatus", "o_orderpriority")


@query("e08_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
def e08(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("e09_distinct_keys", "SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2")
def e09(t):
    """One row per key; the lowest part is kept, so the choice is the same on every run."""
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))


@query("e09_distinct_rows", "SELECT DISTINCT l_orderkey, l_suppkey, l_returnflag FROM lineitem")
def e09b(t):
    return t.lineitem.select("l_orderkey", "l_suppkey", "l_returnflag").distinct()


@query("e10_event_schedule", sql("failures", "SELECT machine_id, date_trunc('day', failure_time)::DATE AS day, array_to_string(list_sort(list_distinct(list(epoch(failure_time)::BIGINT))), ',') AS failure_epochs FROM (SELECT machine_id, date_trunc('second', failure_time) AS failure_time FROM failures) GROUP BY 1, 2"))
def e10(t):
    """Sorted failure seconds per machine and day; a day bounds the array to 86,400 entries."""
    sec = F.unix_seconds(F.col("failure_time").cast("timestamp"))
    return failures(t).groupBy("machine_id", F.to_date("failure_time").alias("day")).agg(
        F.array_join(F.array_sort(F.collect_set(sec)).cast("array<string>"), ",").alias("failure_epochs")
    )


@query("e11_global_bounds", "SELECT min(ts) AS first_ts, max(ts) AS last_ts, max(user_id) AS max_user, greatest(max(user_id), (SELECT max(c_custkey) FROM customer)) AS max_asset FROM events")
def e11(t):
    top = t.customer.agg(F.max("c_custkey").alias("m")).scalar()
    return t.events.agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.max("user_id").alias("max_user")).withColumn(
        "max_asset", F.greatest("max_user", top)
    )


@query("e12_ratio_of_sums", """SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS numerator,
    CAST(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DECIMAL(18,2)) AS denominator,
    round(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN l_discount > 0.05 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END)::DOUBLE, 0), 6) AS ratio FROM lineitem GROUP BY 1""")
def e12(t):
    price = money("l_extendedprice")
    zero = F.lit(0).cast("decimal(18,2)")
    sums = t.lineitem.groupBy("l_suppkey").agg(
        money(F.sum(F.when(F.col("l_returnflag") == "R", price).otherwise(zero))).alias("numerator"),
        money(F.sum(F.when(F.col("l_discount") > 0.05, price).otherwise(zero))).alias("denominator"),
    )
    return sums.withColumn("ratio", r6(F.col("numerator").cast("double") / F.nullif(F.col("denominator").cast("double"), F.lit(0.0))))


@query("e12_mean_downtime_ratio", "SELECT user_id, round(sum(CASE WHEN event_type = 'error' THEN value END), 6) AS numerator, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS denominator, round(sum(CASE WHEN event_type = 'error' THEN value END) / nullif(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 0), 6) AS ratio FROM events GROUP BY 1")
def e12b(t):
    bad = F.col("event_type") == "error"
    out = ratio_of_sums(t.events, ["user_id"], F.when(bad, F.col("value")), bad.cast("long"))
    return out.withColumns({"numerator": r6("numerator"), "ratio": r6("ratio")})


@query("e13_decimal_sums", "SELECT p_brand, CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DECIMAL(18,2)) AS ext_sales, count(*) AS lines FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1 ORDER BY 2 DESC, 1")
def e13(t):
    per_part = t.lineitem.groupBy("l_partkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(15,2)")).alias("s"), F.count(F.lit(1)).alias("n"))
    named = per_part.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return named.groupBy("p_brand").agg(money(F.sum("s")).alias("ext_sales"), F.sum("n").alias("lines")).orderBy(F.desc("ext_sales"), "p_brand")


@query("e14_conditional_rates", sql("predictions", """SELECT risk_level, count(*) AS n, count(*) FILTER (WHERE scored_at IS NOT NULL) AS scored, round(avg(failure_probability), 6) AS mean_probability,
    round(avg(CASE WHEN scored_at IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS scored_rate FROM predictions GROUP BY 1"""))
def e14(t):
    done = F.col("scored_at").isNotNull()
    return predictions(t).groupBy("risk_level").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(done).alias("scored"),
        r6(F.avg("failure_probability")).alias("mean_probability"),
        r6(F.avg(F.when(done, 1.0).otherwise(0.0))).alias("scored_rate"),
    )


@query("e15_duplicate_finder", "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def e15(t):
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("f01_latest_row", "SELECT user_id, event_id, ts, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def f01(t):
    return latest_per_key(t.events, ["user_id"], ["ts", "event_id"], ["event_id", "ts", "event_type", "value"])


@query("f02_latest_with_ties", "SELECT DISTINCT o_custkey, o_orderdate, o_orderpriority FROM orders QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) = 1")
def f02(t):
    return latest_with_ties(t.orders, ["o_custkey"], "o_orderdate", ["o_orderpriority"])


@query("n04_latest_conflicts", """SELECT l_partkey, l_shipdate, count(*) AS versions FROM (SELECT DISTINCT l_partkey, l_shipdate, l_suppkey, l_quantity FROM lineitem QUALIFY dense_rank() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC) = 1) GROUP BY 1, 2 HAVING count(*) > 1""")
def n04(t):
    return latest_conflicts(t.lineitem, ["l_partkey"], "l_shipdate", ["l_suppkey", "l_quantity"])


@query("f03_newest_version", "SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1")
def f03(t):
    known = t.lineitem.where("l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
    return latest_per_key(known, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"], ["l_shipdate", "l_partkey", "l_suppkey"])


@query("f04_multi_key_rank", sql("predictions", """SELECT asset_id, model_version, prediction_id, feature_time, prediction_time FROM predictions QUALIFY row_number() OVER (PARTITION BY asset_id, model_name, model_version, forecast_horizon_hours
    ORDER BY feature_time DESC, coalesce(scored_at, prediction_time) DESC, prediction_time DESC, prediction_id DESC) = 1"""))
def f04(t):
    p = predictions(t).withColumn("effective", F.coalesce("scored_at", "prediction_time"))
    out = latest_per_key(p, ["asset_id", "model_name", "model_version", "forecast_horizon_hours"], ["feature_time", "effective", "prediction_time", "prediction_id"])
    return out.select("asset_id", "model_version", "prediction_id", "feature_time", "prediction_time")


@query("f05_percent_of_total", "SELECT c_nationkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total, round(sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE / (SELECT sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE FROM orders), 6) AS share FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
def f05(t):
    per_customer = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("v"))
    per_nation = per_customer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(money(F.sum("v")).alias("total"))
    out = share_of_total(per_nation.withColumn("_v", F.col("total").cast("double")), "_v")
    return out.select("c_nationkey", "total", r6("share").alias("share"))


@query("f06_year_over_year", """WITH y AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS total FROM orders GROUP BY 1, 2)
    SELECT a.o_orderpriority, a.order_year, round(a.total, 2) AS total, round(b.total, 2) AS previous_total, round((a.total - b.total) / nullif(b.total, 0), 6) AS total_change FROM y a LEFT JOIN y b ON b.o_orderpriority = a.o_orderpriority AND b.order_year = a.order_year - 1""")
def f06(t):
    y = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("order_year")).agg(F.sum(money("o_totalprice")).cast("double").alias("total"))
    out = change_from_previous(y, ["o_orderpriority"], "order_year", "total")
    return out.withColumns({"total": F.round("total", 2), "previous_total": F.round("previous_total", 2), "total_change": r6("total_change")})


@query("f07_neighbour_rows", """SELECT event_id, lag(ts) OVER w AS previous_ts, lead(ts) OVER w AS next_ts, lag(event_type) OVER w AS previous_type, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest_before
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def f07(t):
    out = with_neighbours(
        t.events, ["user_id"], "ts", ["event_id"], {"previous_ts": "ts", "previous_type": "event_type"}, {"next_ts": "ts"}, {"highest_before": F.col("value")}, cell="1 day"
    )
    return out.select("event_id", "previous_ts", "next_ts", "previous_type", "highest_before")


@query("f07_meter_resets", sql("meters", """SELECT meter_reading_id, asset_id, round(previous_hours, 6) AS previous_hours, round(operating_hours, 6) AS operating_hours FROM
    (SELECT *, lag(operating_hours) OVER (PARTITION BY asset_id ORDER BY reading_time, meter_reading_id) AS previous_hours FROM meters) WHERE operating_hours < previous_hours"""))
def f07b(t):
    out = with_neighbours(meters(t), ["asset_id"], "reading_time", ["meter_reading_id"], {"previous_hours": "operating_hours"})
    return out.where("operating_hours < previous_hours").select(
        "meter_reading_id", "asset_id", r6("previous_hours").alias("previous_hours"), r6("operating_hours").alias("operating_hours")
    )


@query("f08_cumulative_curve", """WITH s AS (SELECT value AS score, count(*) FILTER (WHERE event_type = 'error') AS pos, count(*) FILTER (WHERE event_type <> 'error') AS neg FROM events GROUP BY 1)
    SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM s WINDOW w AS (ORDER BY score DESC)""")
def f08(t):
    return score_curve(t.events.withColumn("y", (F.col("event_type") == "error").cast("int")), "value", "y")


@query("f09_top_failing_assets", sql("failures", "SELECT machine_id, count(*) AS failures, row_number() OVER (ORDER BY count(*) DESC, machine_id) AS rank FROM failures GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"))
def f09(t):
    n = failures(t).groupBy("machine_id").agg(F.count(F.lit(1)).alias("failures"))
    return top_k(n, 10, [("failures", True), ("machine_id", False)]).withColumn("rank", F.col("rank").cast("long"))


@query("g01_mixed_order", "SELECT n_regionkey, n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2 ORDER BY 1, 3 DESC, 2")
def g01(t):
    n = t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    out = t.nation.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("n_regionkey", "n_name", F.coalesce("customers", F.lit(0)).alias("customers"))
    return out.orderBy("n_regionkey", F.desc("customers"), "n_name")


@query("g02_existence_probe", "SELECT EXISTS (SELECT 1 FROM events WHERE user_id IS NULL OR ts IS NULL) AS has_null_key, NOT EXISTS (SELECT 1 FROM events) AS is_empty, EXISTS (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS has_duplicates")
def g02(t):
    probe = t.events.agg(
        F.coalesce(F.max(F.col("user_id").isNull() | F.col("ts").isNull()), F.lit(False)).alias("has_null_key"), (F.count(F.lit(1)) == 0).alias("is_empty")
    )
    return probe.withColumn("has_duplicates", duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).exists())


@query("g03_capped_sample", """SELECT o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '-42')) AS rn FROM orders)
    WHERE rn <= CASE o_orderstatus WHEN 'F' THEN 700 WHEN 'O' THEN 150 ELSE 150 END""")
def g03(t):
    order = F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit("-42")))
    return capped_per_group(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": 700, "O": 150, "P": 150}, order)


@query("g04_top_parts", "SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS quantity, row_number() OVER (ORDER BY sum(l_quantity) DESC, l_partkey) AS rank FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def g04(t):
    used = t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").cast("long").alias("quantity"))
    return top_k(used, 20, [("quantity", True), ("l_partkey", False)]).withColumn("rank", F.col("rank").cast("long"))


@query("g05_union_by_name", "SELECT s_suppkey AS party_key, s_name AS party_name, s_nationkey AS nation_key, s_acctbal AS balance FROM supplier UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def g05(t):
    s = t.supplier.select(F.col("s_suppkey").alias("party_key"), F.col("s_name").alias("party_name"), F.col("s_nationkey").alias("nation_key"), F.col("s_acctbal").alias("balance"))
    c = t.customer.select(F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation_key"), F.col("c_name").alias("party_name"), F.col("c_custkey").alias("party_key"))
    return s.unionByName(c)


@query("g06_select_distinct", sql("failures", "SELECT DISTINCT machine_id, failure_time FROM failures"))
def g06(t):
    return failures(t).distinct()


@query("n05_state_issues", sql("states", """SELECT kind, count(*) AS issues FROM (SELECT CASE WHEN state_end <= state_start THEN 'invalid' END AS kind FROM states) WHERE kind IS NOT NULL GROUP BY 1
    UNION ALL SELECT CASE WHEN r > state_start THEN 'overlap' ELSE 'gap' END, count(*) FROM (SELECT *, max(e) OVER (PARTITION BY asset_id ORDER BY state_start, state_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r
      FROM (SELECT *, coalesce(state_end, TIMESTAMP '9999-01-01') AS e FROM states) WHERE e > state_start) WHERE r IS NOT NULL AND r <> state_start GROUP BY 1"""))
def n05(t):
    found = interval_issues(states(t), ["asset_id"], "state_start", "state_end", "state_id")
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("issues"))
