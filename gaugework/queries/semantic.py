"""Metric views, stored summaries, row filters and drill paths."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import functions as F

from ..plans import semantic as sem, summaries as sums, taxes as tax
from ..session import scratch_path
from ..sources.sinks import save_table
from ..sources.tax_tables import dim_tax_line
from .registry import query
from .taxes import returns, FED, FED_LINES, FED_SUMMARY, ST, ST_LINES, ST_SUMMARY, federal, state, w


def sales_view(t):
    return sem.MetricView(
        source=t.orders,
        lookups={
            "customer": sem.Lookup(t.customer, "source.o_custkey = customer.c_custkey"),
            "nation": sem.Lookup(t.nation, "customer.c_nationkey = nation.n_nationkey"),
            "region": sem.Lookup(t.region, "nation.n_regionkey = region.r_regionkey"),
        },
        dimensions={"segment": "customer.c_mktsegment", "region": "region.r_name", "order_year": "year(source.o_orderdate)", "status": "source.o_orderstatus"},
        measures={
            "orders": "count(1)",
            "revenue": "cast(sum(cast(source.o_totalprice AS decimal(18,2))) AS decimal(18,2))",
            "large_share": "round(count_if(source.o_totalprice > 300000) / count(1), 6)",
        },
        filter="source.o_orderstatus <> 'P'",
    )


@query("p01_metric_by_region", """SELECT r_name AS region, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def p01(t):
    return sem.metric_query(sales_view(t), ["region", "order_year"], ["orders", "revenue"])


@query("p01_metric_without_lookups", "SELECT o_orderstatus AS status, count(*) AS orders, round(count(*) FILTER (WHERE o_totalprice > 300000) / count(*), 6) AS large_share FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1")
def p01b(t):
    return sem.metric_query(sales_view(t), ["status"], ["orders", "large_share"], "source.o_orderpriority = '1-URGENT'")


@query("p01_metric_by_segment", "SELECT c_mktsegment AS segment, count(*) AS orders FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' GROUP BY 1")
def p01c(t):
    return sem.metric_query(sales_view(t), ["segment"], ["orders"])


def stored(df, label):
    return save_table(df, scratch_path(df.sparkSession, label))


@query("p02_stored_federal_summary", w((*FED, FED_LINES, FED_SUMMARY), "SELECT * FROM fs"))
def p02(t):
    return stored(tax.federal_summary(federal(t)), "federal-summary")


@query("p02_child_of_stored_summary", w((*FED, *ST, ST_LINES, ST_SUMMARY), "SELECT tax_year, CAST(sum(state_tax) AS DECIMAL(18,2)) AS state_tax, CAST(sum(state_taxable_income) AS DECIMAL(18,2)) AS state_taxable_income FROM ss GROUP BY 1"))
def p02b(t):
    parent = stored(tax.state_summary(state(t)), "state-summary")
    return parent.groupBy("tax_year").agg(*[F.sum(c).cast("decimal(18,2)").alias(c) for c in ("state_tax", "state_taxable_income")])


@query("p03_row_security", w((*FED, FED_LINES, FED_SUMMARY), "SELECT * FROM fs WHERE entity_key IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)"))
def p03(t):
    """A region's manager sees the nations of that region."""
    grants = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("user_name"), F.col("n_nationkey").alias("entity_key"))
    return sem.for_user(tax.federal_summary(federal(t)), grants, "ASIA", "entity_key")


@query("p04_relative_date", "SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-24' AND ts < TIMESTAMP '2024-01-31'")
def p04(t):
    return sem.recent(t.events.select("event_id", "user_id", "ts"), "ts", datetime(2024, 1, 31), "7 days")


@query("p05_required_filters", w((*FED, FED_LINES), "SELECT return_id, employee_key, entity_key, tax_year, tax_line_key, amount FROM fl WHERE tax_year = 1998 AND entity_key IN (1, 2)"))
def p05(t):
    return sem.detail(federal(t), {"tax_year": [1998], "entity_key": [1, 2]}).drop("income_type_key")


@query("p06_drill_path", w((*FED, FED_LINES), """SELECT return_id, tax_line_key AS line_sequence, CASE tax_line_key WHEN 1 THEN 'F_WAGES' WHEN 2 THEN 'F_BONUS' WHEN 3 THEN 'F_EQUITY' WHEN 4 THEN 'F_INT' WHEN 5 THEN 'F_DIV' WHEN 6 THEN 'F_OTHER' WHEN 7 THEN 'F_AGI' WHEN 8 THEN 'F_STD_DED'
    WHEN 9 THEN 'F_TAXABLE' WHEN 10 THEN 'F_TAX' WHEN 11 THEN 'F_CREDITS' WHEN 12 THEN 'F_WITHHELD' WHEN 13 THEN 'F_BAL' ELSE 'F_EFF_RATE_BASIS' END AS tax_line_code, amount FROM fl WHERE return_id = (SELECT max(return_id) FROM r)"""))
def p06(t):
    """The trail of the last return by id; the id is found by the query itself."""
    lines = federal(t)
    last = returns(t).agg(F.max("return_id").alias("m")).scalar()
    return sem.drill(lines, dim_tax_line(t.spark), last)


def sales(t, orders=None):
    view = sales_view(t)
    if orders is not None:
        view = replace(view, source=orders)
    price = "cast(source.o_totalprice AS decimal(18,2))"
    partials = {
        "n": sums.Partial("count(1)"),
        "value": sums.Partial(f"cast(sum({price}) AS decimal(28,2))"),
        "large": sums.Partial(f"count_if({price} > 300000)"),
        "highest": sums.Partial(f"max({price})", "max"),
        "buyers": sums.Partial("count(distinct source.o_custkey)", None),
    }
    formulas = {"orders": "n", "revenue": "cast(value AS decimal(18,2))", "large_share": "round(large / n, 6)", "highest_price": "highest", "customers": "buyers"}
    return sums.Definition(view, partials, formulas)


KEPT = "FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P' AND NOT (o_orderkey % 5 = 2 AND o_orderstatus = 'F')"


@query("p02_summary_kept_by_deltas", f"SELECT c_mktsegment AS segment, CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue, round(count(*) FILTER (WHERE CAST(o_totalprice AS DECIMAL(18,2)) > 300000) / count(*), 6) AS large_share {KEPT} GROUP BY 1, 2")
def p02c(t):
    """A summary of some orders, a fifth of them with wrong prices, then new orders, corrections and removals, one of these repeated."""
    fifth = F.col("o_orderkey") % 5
    wrong = t.orders.where(fifth == 0).withColumn("o_totalprice", F.col("o_totalprice") + 100_000)
    first = sales(t, wrong.unionByName(t.orders.where(fifth.isin(1, 2))))
    kept = sums.store(first, scratch_path(t.spark, "p02c"), ["segment", "order_year"], ["n", "value", "large"], "order_year")
    sums.apply_delta(first, kept, sums.delta(first, kept, added=t.orders.where(fifth == 3)), "new")
    sums.apply_delta(first, kept, sums.delta(first, kept, t.orders.where(fifth == 0), wrong), "corrected")
    last = sums.delta(first, kept, t.orders.where(fifth == 4), t.orders.where((fifth == 2) & (F.col("o_orderstatus") == "F")))
    for _ in range(2):
        sums.apply_delta(first, kept, last, "removed")
    return sums.answer(t.spark, first, {kept: 1}, ["segment", "order_year"], ["orders", "revenue", "large_share"])


NAVIGATED = """SELECT r_name AS region, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue, max(CAST(o_totalprice AS DECIMAL(18,2))) AS highest_price FROM orders LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey WHERE o_orderstatus <> 'P' AND year(o_orderdate) IN (1995, 1996) GROUP BY 1"""


@query("p01_answered_from_a_summary", NAVIGATED)
def p01d(t):
    """Two grains are stored; the one without the filtered year can't answer, the other one does, without the orders."""
    definition, partials = sales(t), ["n", "value", "large", "highest"]
    base = scratch_path(t.spark, "p01d")
    fine = sums.store(definition, f"{base}/fine", ["region", "segment", "order_year"], partials, "order_year")
    coarse = sums.store(definition, f"{base}/coarse", ["region", "status"], partials, "region")
    stores = {s: s.read(t.spark).count() for s in (fine, coarse)}
    return sums.answer(t.spark, definition, stores, ["region"], ["orders", "revenue", "highest_price"], {"order_year": [1995, 1996]})
