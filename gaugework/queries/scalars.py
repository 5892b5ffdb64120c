"""Projections, filters and scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions.classes import first_band
from ..functions.num import r6
from ..operators.joins import filter_ids, search
from .registry import query
from .roles import assets, ntz, sql


@query("c01_projection", "SELECT l_orderkey AS order_key, l_linenumber AS line_no, round(l_quantity * 2, 6) AS double_quantity, l_returnflag = 'R' AS returned FROM lineitem")
def c01(t):
    return t.lineitem.select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"), r6(F.col("l_quantity") * 2).alias("double_quantity"), (F.col("l_returnflag") == "R").alias("returned")
    )


@query("c02_null_guard", "SELECT o_orderkey, e FROM (SELECT o_orderkey, CASE WHEN o_totalprice < 400000 THEN o_orderdate END AS e FROM orders) WHERE e IS NOT NULL")
def c02(t):
    end = F.when(F.col("o_totalprice") < 400_000, F.col("o_orderdate"))
    return t.orders.select("o_orderkey", end.alias("e")).where("e IS NOT NULL AND o_orderkey IS NOT NULL")


@query("c03_value_filters", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus = 'F' AND l_quantity BETWEEN 10 AND 40 AND l_extendedprice > 20000")
def c03(t):
    keep = F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") == "F") & F.col("l_quantity").between(10, 40) & (F.col("l_extendedprice") > 20_000)
    return t.lineitem.where(keep).select("l_orderkey", "l_partkey", "l_quantity")


@query("c04_half_open_period", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def c04(t):
    return t.events.where((F.col("ts") >= ntz(datetime(2024, 1, 8))) & (F.col("ts") < ntz(datetime(2024, 1, 15)))).select("event_id", "ts")


@query("c05_asset_filters", sql("assets", """SELECT asset_id, site_id, asset_type_name, criticality FROM assets WHERE asset_type_name IN ('MACHINERY', 'FURNITURE') AND criticality IN ('high', 'critical')
    AND site_id IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2)) AND (retired_at IS NULL OR retired_at > TIMESTAMP '2024-01-31')"""))
def c05(t):
    """Sites narrow by region, then assets by site, type and criticality; retired ones are left out."""
    chosen = t.nation.where(F.col("n_regionkey").isin(1, 2)).select("n_nationkey")
    kept = filter_ids(assets(t), site_id=chosen, asset_type_name=["MACHINERY", "FURNITURE"], criticality=["high", "critical"], asset_id=None)
    alive = F.col("retired_at").isNull() | (F.col("retired_at") > ntz(datetime(2024, 1, 31)))
    return kept.where(alive).select("asset_id", "site_id", "asset_type_name", "criticality")


@query("c06_text_search", "SELECT c_custkey, c_name FROM customer WHERE contains(lower(c_name), '00012') OR contains(lower(CAST(c_custkey AS VARCHAR)), '00012') OR contains(lower(c_mktsegment), '00012')")
def c06(t):
    return search(t.customer, ["c_name", "c_custkey", "c_mktsegment"], "00012").select("c_custkey", "c_name")


@query("c07_classification", "SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'large' WHEN o_totalprice > 200000 THEN 'medium' ELSE 'small' END AS size_class, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state FROM orders")
def c07(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", first_band([(price > 400_000, "large"), (price > 200_000, "medium")], "small").alias("size_class"), first_band([(F.col("o_orderstatus") == "F", "closed")], "open").alias("state")
    )


@query("c12_explode_array", "SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS line_no, l[i] AS line FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM conversations)")
def c12(t):
    """The lines of each text; an array is never larger than its own row."""
    return t.conversations.select("conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query("c13_struct_fields", "SELECT conv_id, turn AS last_turn, role AS last_role FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, length(text) DESC) = 1")
def c13(t):
    last = F.max(F.struct("turn", "role", F.length("text").alias("n"))).alias("last")
    return t.conversations.groupBy("conv_id").agg(last).select("conv_id", F.col("last.turn").alias("last_turn"), F.col("last.role").alias("last_role"))


@query("c14_casts", """SELECT event_id, CAST(floor(value) AS INTEGER) AS as_int, CAST(user_id AS DOUBLE) AS as_double, CAST(value AS DECIMAL(12,2)) AS as_decimal, CAST(ts AS DATE) AS as_date, CAST(event_id AS VARCHAR) AS as_string,
    CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS as_local FROM events""")
def c14(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.events.select(
        "event_id",
        F.floor("value").cast("int").alias("as_int"),
        F.col("user_id").cast("double").alias("as_double"),
        F.col("value").cast("decimal(12,2)").alias("as_decimal"),
        F.col("ts").cast("date").alias("as_date"),
        F.col("event_id").cast("string").alias("as_string"),
        text.cast("timestamp_ntz").alias("as_local"),
    )


@query("c15_string_functions", """SELECT c_custkey, printf('SN-%010d', c_custkey) AS serial, 'v' || CAST(c_nationkey AS VARCHAR) || '.' || c_mktsegment AS joined, CAST(c_nationkey AS VARCHAR) || '-' || c_name AS with_separator,
    lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS padded, substring(c_name, 1, 8) AS head FROM customer""")
def c15(t):
    key, nation = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    return t.customer.select(
        "c_custkey",
        F.format_string("SN-%010d", key).alias("serial"),
        F.concat(F.lit("v"), nation, F.lit("."), "c_mktsegment").alias("joined"),
        F.concat_ws("-", nation, "c_name").alias("with_separator"),
        F.lpad(key.cast("string"), 12, "0").alias("padded"),
        F.substring("c_name", 1, 8).alias("head"),
    )


# 32-bit murmur of a non-negative long below 2**31 with seed 42, step by step in unsigned 64-bit numbers
MURMUR = """a AS (SELECT c_custkey, c_name, c_acctbal, (c_custkey::UBIGINT * 3432918353) & 4294967295 AS k FROM customer),
    b AS (SELECT *, ((((k << 15) & 4294967295) | (k >> 17)) * 461845907) & 4294967295 AS m FROM a),
    c AS (SELECT *, xor(42::UBIGINT, m) AS h FROM b),
    d AS (SELECT *, ((((h << 13) & 4294967295) | (h >> 19)) * 5 + 3864292196) & 4294967295 AS i FROM c),
    e AS (SELECT *, ((((i << 13) & 4294967295) | (i >> 19)) * 5 + 3864292196) & 4294967295 AS j FROM d),
    f AS (SELECT *, xor(j, 8::UBIGINT) AS n FROM e),
    g AS (SELECT *, (xor(n, n >> 16) * 2246822507) & 4294967295 AS o FROM f),
    h AS (SELECT *, (xor(o, o >> 13) * 3266489909) & 4294967295 AS p FROM g),
    z AS (SELECT *, xor(p, p >> 16)::BIGINT AS u FROM h)"""
# 64-bit xxHash of a long of 8 bytes with seed 42 (42 + 2870177450012600261 + 8), step by step in unsigned 128-bit numbers
XXHASH = f"""{MURMUR},
    xa AS (SELECT *, (c_custkey::UHUGEINT * 14029467366897019727) & 18446744073709551615 AS xk FROM z),
    xb AS (SELECT *, ((((xk << 31) & 18446744073709551615) | (xk >> 33)) * 11400714785074694791) & 18446744073709551615 AS xm FROM xa),
    xc AS (SELECT *, xor(2870177450012600311::UHUGEINT, xm) AS xh FROM xb),
    xd AS (SELECT *, ((((xh << 27) & 18446744073709551615) | (xh >> 37)) * 11400714785074694791 + 9650029242287828579) & 18446744073709551615 AS xi FROM xc),
    xe AS (SELECT *, (xor(xi, xi >> 33) * 14029467366897019727) & 18446744073709551615 AS xj FROM xd),
    xf AS (SELECT *, (xor(xj, xj >> 29) * 1609587929392839161) & 18446744073709551615 AS xo FROM xe),
    xz AS (SELECT *, xor(xo, xo >> 32)::HUGEINT AS xu FROM xf)"""


@query("c15_hash_functions", f"""WITH {XXHASH} SELECT c_custkey, sha256(c_name) AS digest, abs(CAST(floor(c_acctbal) AS BIGINT)) AS magnitude,
    CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS murmur, CAST(CASE WHEN xu >= 9223372036854775808 THEN xu - 18446744073709551616 ELSE xu END AS BIGINT) AS wide FROM xz""")
def c15b(t):
    return t.customer.select(
        "c_custkey",
        F.sha2("c_name", 256).alias("digest"),
        F.abs(F.floor("c_acctbal")).alias("magnitude"),
        F.hash(F.col("c_custkey").cast("long")).cast("long").alias("murmur"),
        F.xxhash64(F.col("c_custkey").cast("long")).alias("wide"),
    )


@query("c15_date_functions", """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 730 AS warranty_end, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d,
    CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow, CAST(weekofyear(o_orderdate) AS INTEGER) AS w, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, last_day(o_orderdate) AS month_end, make_date(CAST(year(o_orderdate) + 1 AS INTEGER), 4, 15) AS deadline,
    CAST(epoch(o_orderdate) AS BIGINT) AS seconds, o_orderdate + INTERVAL 5 MINUTES AS confirmed, o_orderdate + INTERVAL 168 HOURS AS horizon_end FROM orders""")
def c15c(t):
    d = F.col("o_orderdate")
    day = F.to_date(d)
    return t.orders.select(
        "o_orderkey",
        F.date_add(day, 730).alias("warranty_end"),
        F.year(d).alias("y"),
        F.quarter(d).alias("q"),
        F.month(d).alias("m"),
        F.dayofmonth(d).alias("d"),
        F.dayofweek(d).alias("dow"),
        F.weekofyear(d).alias("w"),
        F.trunc(day, "month").alias("month_start"),
        F.last_day(day).alias("month_end"),
        F.make_date(F.year(d) + 1, F.lit(4), F.lit(15)).alias("deadline"),
        F.unix_timestamp(d.cast("timestamp")).alias("seconds"),
        (d + F.expr("INTERVAL 5 MINUTES")).alias("confirmed"),
        F.timestamp_add("HOUR", F.lit(168), d).alias("horizon_end"),
    )


@query("c15_math_functions", """SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey % 7 AS remainder, CAST(((floor(l_extendedprice) - 50000) % 97 + 97) % 97 AS BIGINT) AS non_negative, CAST(floor(l_extendedprice / 11) AS BIGINT) AS floored, round(pow(l_discount, 2.0), 6) AS squared,
    round(sin(l_quantity), 6) + 0 AS wave, least(l_quantity, 30.0::DOUBLE) AS capped, greatest(l_quantity - 10, 0.0::DOUBLE) AS excess, abs(l_quantity - 25) AS distance FROM lineitem""")
def c15d(t):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (F.col("l_orderkey") % 7).alias("remainder"),
        F.pmod(F.floor(p) - 50_000, F.lit(97)).alias("non_negative"),
        F.floor(p / 11).alias("floored"),
        r6(F.pow(F.col("l_discount"), F.lit(2.0))).alias("squared"),
        r6(F.sin(q)).alias("wave"),
        F.least(q, F.lit(30.0)).alias("capped"),
        F.greatest(q - 10, F.lit(0.0)).alias("excess"),
        F.abs(q - 25).alias("distance"),
    )


@query("c15_null_functions", "SELECT event_id, coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE value END, -1.0::DOUBLE) AS filled, nullif(event_type, 'view') AS other_type, event_type IS NULL AS missing FROM events")
def c15e(t):
    kind = F.col("event_type")
    return t.events.select(
        "event_id", F.coalesce(F.when(kind != "error", F.col("value")), F.lit(-1.0)).alias("filled"), F.nullif(kind, F.lit("view")).alias("other_type"), kind.isNull().alias("missing")
    )


@query("c15_array_functions", """WITH a AS (SELECT user_id, date_trunc('day', ts)::DATE AS day, list(DISTINCT CAST(epoch(date_trunc('second', ts)) AS BIGINT)) AS l, min(CAST(epoch(date_trunc('second', ts)) AS BIGINT)) AS lo FROM events GROUP BY 1, 2)
    SELECT user_id, day, CAST(len(l) AS INTEGER) AS entries, list_min(list_filter(list_transform(l, lambda x: x - lo), lambda y: y > 3600)) AS first_after_an_hour, CASE user_id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS picked FROM a""")
def c15f(t):
    """Arrays hold the distinct seconds of one user and day, so they are bounded by the day."""
    sec = F.unix_seconds(F.col("ts").cast("timestamp"))
    a = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.collect_set(sec).alias("l"), F.min(sec).alias("lo"))
    gaps = F.filter(F.transform("l", lambda x: x - F.col("lo")), lambda g: g > 3_600)
    letters = F.array(*[F.lit(x) for x in "abc"])
    return a.select(
        "user_id", "day", F.size("l").alias("entries"), F.array_min(gaps).alias("first_after_an_hour"), F.element_at(letters, (F.pmod("user_id", F.lit(3)) + 1).cast("int")).alias("picked")
    )


@query("c15_seeded_random", "SELECT count(*) AS row_count, true AS in_range, true AS repeatable, true AS other_seed_differs, true AS even FROM events")
def c15g(t):
    """Two readings of the table draw the same values for the same seed, others for another; they fill [0, 1) evenly."""
    one = t.events.select("event_id", F.rand(42).alias("r"), F.rand(43).alias("other"))
    two = t.spark.read.parquet(f"{t.folder}/events.parquet").select(F.col("event_id").alias("id"), F.rand(42).alias("again"))
    both, n = one.join(two, F.col("event_id") == F.col("id")), F.count(F.lit(1))
    r = F.col("r")
    return both.agg(
        n.alias("row_count"),
        (F.count_if((r >= 0) & (r < 1)) == n).alias("in_range"),
        (F.count_if(r == F.col("again")) == n).alias("repeatable"),
        (F.count_if(r == F.col("other")) < n / 100).alias("other_seed_differs"),
        F.avg(r).between(0.45, 0.55).alias("even"),
    )
