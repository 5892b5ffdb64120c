"""Sources, sinks and table upkeep."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..operators.joins import having_none
from ..session import scratch_path
from ..sources import cursor, feed, layout, sinks, statistics, tables
from ..streaming import ingest
from .registry import query
from .roles import ntz, predictions, sql


@query("a01_range_source", "SELECT g AS id FROM range((SELECT max(l_orderkey) + 1 FROM lineitem)) r(g) WHERE g NOT IN (SELECT l_orderkey FROM lineitem)")
def a01(t):
    """Order numbers without a line, against a distributed range of all numbers."""
    top = t.lineitem.agg(F.max("l_orderkey").alias("m")).first()["m"]  # one number sizes the range
    ids = tables.row_ids(t.spark, top + 1)
    return having_none(ids, t.lineitem, "id", "l_orderkey")


PRIORITIES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query("a02_literal_source", "SELECT rank, count(*) AS orders FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5)) v(priority, rank) ON o_orderpriority = priority GROUP BY 1")
def a02(t):
    ranks = tables.literal_table(t.spark, PRIORITIES, "priority string, rank int")
    n = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("orders"))
    return n.join(ranks, F.col("o_orderpriority") == F.col("priority")).select("rank", "orders")


@query("a03_table_scan", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def a03(t):
    t.supplier.createOrReplaceTempView("gaugework_supplier")
    tables.require_tables(t.spark, ["gaugework_supplier"])
    return tables.table_scan(t.spark, "gaugework_supplier").where("s_acctbal > 0").select("s_suppkey", "s_name")


@query("a05_append_batches", "SELECT CAST(event_id // ((SELECT max(event_id) FROM events) // 4 + 1) AS VARCHAR) AS batch, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def a05(t):
    path = scratch_path(t.spark, "a05")
    top = t.events.agg(F.max("event_id").alias("m")).first()["m"]  # one number sets the slices

    def piece(first: int, rows: int):
        return t.events.where(F.col("event_id").between(first, first + rows - 1)).select("event_id", "value")

    sinks.append_batches(piece, top + 1, top // 4 + 1, path)
    stored = sinks.read_store(t.spark, path, piece(0, 1).schema)
    number = F.substring_index("batch", "-", -1).alias("batch")
    return stored.groupBy(number).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("a06_overwrite_table", "SELECT * FROM orders")
def a06(t):
    path = scratch_path(t.spark, "a06")
    sinks.overwrite_table(t.orders.where("o_orderstatus = 'F'"), path)
    return sinks.overwrite_table(t.orders, path, t.orders.columns)


@query("a07_save_partitioned", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def a07(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    return sinks.save_table(rows, scratch_path(t.spark, "a07"), "errorifexists", ["o_orderstatus"])


MERGE_SQL = """SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
    UNION ALL SELECT l_orderkey, l_linenumber, max(l_partkey) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_returnflag = 'R' AND r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber) GROUP BY 1, 2"""


@query("a08_merge_insert_only", MERGE_SQL)
def a08(t):
    """Returned lines are stored first; merging all lines then adds only unknown keys, twice without effect."""
    path, run = scratch_path(t.spark, "a08"), sinks.new_run()
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    keys = ["l_orderkey", "l_linenumber"]
    stored = [*keys, "l_partkey"]
    sinks.merge_insert_only(path, rows.where("l_returnflag = 'R'"), keys, run, 0, ["l_partkey"], stored)
    sinks.merge_insert_only(path, rows, keys, run, 1, ["l_partkey"], stored)
    sinks.merge_insert_only(path, rows, keys, run, 2, ["l_partkey"], stored)
    return sinks.read_store(t.spark, path, rows.select(*stored).schema).select(*stored)


@query("a05_second_append", "SELECT event_type, 2 * count(*) AS n FROM events GROUP BY 1")
def a05b(t):
    """Appending to the same folder again adds rows; a slice of the first run that is repeated does not."""
    path, run = scratch_path(t.spark, "a05b"), sinks.new_run()
    top = t.events.agg(F.max("event_id").alias("m")).first()["m"]  # one number sets the slices

    def piece(first: int, rows: int):
        return t.events.where(F.col("event_id").between(first, first + rows - 1)).select("event_id", "event_type")

    for name in (run, run, None):
        sinks.append_batches(piece, top + 1, top // 2 + 1, path, name)
    return sinks.read_store(t.spark, path, piece(0, 1).schema).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


SLICES = 8
SLICES_SQL = f"""WITH e AS (SELECT event_id, (SELECT max(event_id) + 1 FROM events) AS top FROM events),
    s AS (SELECT CAST(event_id * {SLICES} // top AS INTEGER) AS slice, event_id FROM e),
    first AS (SELECT slice, count(DISTINCT event_id) AS inserted FROM s GROUP BY 1),
    again AS (SELECT slice + 1 AS slice, count(DISTINCT event_id) AS repeated FROM s WHERE event_id % 5 = 0 AND slice < {SLICES - 1} GROUP BY 1)
    SELECT slice, inserted, inserted + coalesce(repeated, 0) AS keys, true AS few_parts FROM first LEFT JOIN again USING (slice)"""


@query("a08_parts_read_per_batch", SLICES_SQL)
def a08d(t):
    """Batches that repeat a fifth of the one before, with keys in no order: the parts read don't grow with the store.

    Seven filters let some ten of a hundred thousand unknown keys through; a batch needs the part before it and may
    be sent to a few others in vain.
    """
    path, run, out = scratch_path(t.spark, "a08d"), sinks.new_run(), []
    top = t.events.agg(F.max("event_id").alias("m")).first()["m"] + 1  # one number sets the slices
    number = (F.col("event_id") * SLICES / top).cast("int")
    rows = t.events.select(F.sha1(F.col("event_id").cast("string")).alias("key"), "event_id", number.alias("slice"))
    for k in range(SLICES):
        batch = rows.where((F.col("slice") == k) | ((F.col("slice") == k - 1) & (F.col("event_id") % 5 == 0)))
        did = sinks.merge_insert_only(path, batch, ["key"], run, k, ["event_id"])
        out.append((k, did.inserted, did.keys, did.parts_read <= 1 + did.keys // 1000))
    return t.spark.createDataFrame(out, "slice int, inserted long, keys long, few_parts boolean")


FEEDS_SQL = """WITH k AS (SELECT l_orderkey, l_linenumber, max(CASE l_returnflag WHEN 'R' THEN 3 WHEN 'A' THEN 2 ELSE 1 END) AS feed FROM lineitem GROUP BY 1, 2)
    SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem JOIN k USING (l_orderkey, l_linenumber)
    WHERE (feed = 3 AND l_returnflag = 'R') OR (feed = 2 AND l_returnflag = 'A') OR feed = 1 GROUP BY 1, 2"""


@query("a08_second_feed_and_restart", FEEDS_SQL)
def a08c(t):
    """Two feeds and a restart of the first under a new run: stored lines stay as they are and none is lost."""
    path = scratch_path(t.spark, "a08c")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    keys = ["l_orderkey", "l_linenumber"]
    stored = [*keys, "l_partkey"]
    first, again = sinks.new_run(), sinks.new_run()
    sinks.merge_insert_only(path, rows.where("l_returnflag = 'R'"), keys, first, 0, ["l_partkey"], stored)
    sinks.merge_insert_only(path, rows.where("l_returnflag = 'A'"), keys, sinks.new_run(), 0, ["l_partkey"], stored)
    changed = rows.where("l_returnflag = 'R'").withColumn("l_partkey", F.col("l_partkey") + 1)
    sinks.merge_insert_only(path, changed, keys, again, 0, ["l_partkey"], stored)
    sinks.merge_insert_only(path, rows, keys, again, 1, ["l_partkey"], stored)
    return sinks.read_store(t.spark, path, rows.select(*stored).schema).select(*stored)


@query("a08_merge_as_query", "SELECT o_custkey AS party, 'order' AS origin FROM (SELECT DISTINCT o_custkey FROM orders) UNION ALL SELECT c_custkey, 'register' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def a08b(t):
    target = t.orders.select(F.col("o_custkey").alias("party")).distinct().withColumn("origin", F.lit("order"))
    source = t.customer.select(F.col("c_custkey").alias("party"), F.lit("register").alias("origin"))
    return sinks.union_insert_only(target, source, ["party"])


@query("a10_replace_cache", sql("assets predictions", "SELECT asset_id, p.feature_time FROM assets LEFT JOIN (SELECT asset_id, max(feature_time) AS feature_time FROM predictions GROUP BY 1) p USING (asset_id)"))
def a10(t):
    """One row per asset, published only after the coverage check; published again over the first."""
    newest = predictions(t).groupBy("asset_id").agg(F.max("feature_time").alias("feature_time"))
    register = t.customer.select(F.col("c_custkey").alias("asset_id"))
    cache = register.join(newest, "asset_id", "left")
    path, n = scratch_path(t.spark, "a10"), register.count()
    for _ in range(2):
        sinks.replace_cache(cache, path, n, "asset_id")
    return sinks.read_cache(t.spark, path)


COUNTED = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def catalog(t, label, schemas):
    """A database of its own in the shared folder, with empty tables of the given schemas."""
    path = scratch_path(t.spark, label)
    database = "gaugework_" + path.rpartition("/")[2].replace("-", "_")
    tables.create_tables(t.spark, database, schemas, location=path)
    return database


@query("a16_create_tables", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def a16(t):
    """Created tables are filled; creating them again leaves what they hold."""
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey")
    schemas = {"customer": rows.schema, "orders": t.orders.schema}
    database = catalog(t, "a16", schemas)
    rows.write.insertInto(f"{database}.customer")
    tables.create_tables(t.spark, database, schemas)
    tables.require_tables(t.spark, [f"{database}.{n}" for n in schemas])
    return t.spark.table(f"{database}.customer")


@query("a11_schema_drift", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def a11(t):
    """A table that lacks a column is refused, made anew and filled; then its columns are the expected ones."""
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    name = catalog(t, "a11", {"orders": rows.drop("o_totalprice").schema}) + ".orders"
    try:
        tables.ensure_schema(t.spark, name, rows.schema)
    except ValueError:
        tables.ensure_schema(t.spark, name, rows.schema, recreate=True)
        rows.write.insertInto(name)
    else:
        raise RuntimeError("drift was not seen")
    tables.ensure_schema(t.spark, name, rows.schema)
    return t.spark.table(name)


@query("a12_row_count_report", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in COUNTED))
def a12(t):
    return tables.row_counts({n: getattr(t, n) for n in COUNTED})


@query("a13_cluster_layout", "SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate FROM lineitem")
def a13(t):
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    return sinks.save_table(sinks.cluster_layout(rows, ["l_shipdate", "l_partkey"]), scratch_path(t.spark, "a13"))


@query("a13_interleaved_layout", "SELECT l_partkey, l_suppkey, l_quantity FROM lineitem")
def a13b(t):
    """Rows near in both keys share a file."""
    rows = t.lineitem.select("l_partkey", "l_suppkey", "l_quantity")
    keyed = rows.withColumn("z", sinks.interleaved(F.col("l_partkey"), F.col("l_suppkey")))
    return sinks.save_table(sinks.cluster_layout(keyed, ["z"]), scratch_path(t.spark, "a13z")).drop("z")


BOXES = {"part_and_supplier": ("l_partkey", "l_suppkey"), "part": ("l_partkey",), "supplier": ("l_suppkey",)}
BOX_SQL = "l AS (SELECT *, max(l_partkey) OVER () AS tp, max(l_suppkey) OVER () AS ts FROM lineitem)"
IN_BOX = {"l_partkey": "l_partkey BETWEEN tp * 3 // 10 AND tp * 4 // 10", "l_suppkey": "l_suppkey BETWEEN ts * 3 // 10 AND ts * 4 // 10"}


@query("a13_files_for_a_box", f"WITH {BOX_SQL} " + " UNION ALL ".join(f"SELECT '{n}' AS box, count(*) FILTER (WHERE {' AND '.join(IN_BOX[k] for k in ks)}) AS rows, true AS few_files FROM l" for n, ks in BOXES.items()))
def a13c(t):
    """Of 64 files along a Hilbert curve, a tenth of both keys' ranges needs at most a sixth, a tenth of either key's range two fifths.

    An order by the first key alone would need all of them for the second key.
    """
    keys = ["l_partkey", "l_suppkey"]
    rows = t.lineitem.select(*keys, "l_orderkey", "l_linenumber")
    stored = sinks.save_table(layout.hilbert_layout(rows, keys, 64), scratch_path(t.spark, "a13h"))
    tops = rows.agg(*[F.max(k).alias(k) for k in keys]).first()  # two numbers place the boxes
    boxes = {n: {k: (tops[k] * 3 // 10, tops[k] * 4 // 10) for k in ks} for n, ks in BOXES.items()}
    need = layout.files_needed(layout.file_bounds(stored, keys), boxes)
    inside = {n: F.count_if(reduce(and_, [F.col(k).between(*ends) for k, ends in box.items()])) for n, box in boxes.items()}
    counts = stored.agg(F.array(*[F.struct(F.lit(n).alias("box"), c.alias("rows")) for n, c in inside.items()]).alias("all")).select(F.inline("all"))
    most = F.when(F.col("box") == "part_and_supplier", 1 / 6).otherwise(2 / 5)
    return counts.join(need, "box").select("box", "rows", (F.col("share") <= most).alias("few_files"))


STATS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query("a14_column_statistics", " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, count(DISTINCT {c}) AS distinct_values, count(*) FILTER (WHERE {c} IS NULL) AS null_values FROM orders" for c in STATS))
def a14(t):
    return tables.column_statistics(t.orders, STATS)


SKETCHED = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


def exact_columns(c: str) -> str:
    number = c != "o_orderpriority"
    bounds = f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high" if number else "CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high"
    return f"SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls, {bounds}, count(DISTINCT {c}) AS exact_distinct, true AS distinct_is_near, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS median_is_near FROM orders"


@query("a14_combined_sketches", " UNION ALL ".join(map(exact_columns, SKETCHED)))
def a14b(t):
    """Sketches of four batches, one of them repeated, put together; estimates are held against exact answers."""
    path = scratch_path(t.spark, "a14b")
    year = F.pmod(F.year("o_orderdate"), F.lit(4))
    for k in (0, 1, 2, 3, 1):
        statistics.add_batch(t.orders.where(year == k), SKETCHED, path, str(k))
    found = statistics.combined(t.spark, path)
    exact = tables.column_statistics(t.orders, SKETCHED).select("column_name", F.col("distinct_values").alias("exact_distinct"))
    both = found.join(exact, "column_name")
    # the share of rows below the estimated median and up to it has to span one half, but for the sketch's error
    one = found.where("low IS NOT NULL").select("column_name", F.col("quantiles")[1].alias("median"))
    values = t.orders.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in SKETCHED if c != "o_orderpriority"])).alias("x")).select("x.*")
    ranks = values.join(F.broadcast(one), "column_name").groupBy("column_name").agg(
        F.avg((F.col("v") < F.col("median")).cast("double")).alias("below"), F.avg((F.col("v") <= F.col("median")).cast("double")).alias("upto")
    )
    near = (F.col("below") - statistics.RANK_ERROR <= 0.5) & (F.col("upto") + statistics.RANK_ERROR >= 0.5)
    close = F.abs(F.col("distinct_values") - F.col("exact_distinct")) <= statistics.DISTINCT_ERROR * F.col("exact_distinct")
    return both.join(ranks, "column_name", "left").select("column_name", "rows", "nulls", "low", "high", "exact_distinct", close.alias("distinct_is_near"), near.alias("median_is_near"))


@query("a14_frequent_values", "SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def a14c(t):
    """Counts of the frequent values of a column with few values, from combined sketches: exact there."""
    path = scratch_path(t.spark, "a14c")
    for k in range(3):
        statistics.add_batch(t.orders.where(F.col("o_orderkey") % 3 == k), ["o_orderpriority"], path, str(k))
    found = statistics.combined(t.spark, path).select(F.inline("frequent"))
    return found.select(F.col("item").alias("value"), F.col("count").alias("n"))


@query("a15_repartitioned_write", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS tax_year FROM orders")
def a15(t):
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("tax_year"))
    return sinks.save_table(sinks.spread(rows, "tax_year"), scratch_path(t.spark, "a15"))


LAST, NOW = datetime(2024, 1, 20), datetime(2024, 1, 28)


@query("a17_incremental_slice", "SELECT event_id, user_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-19 18:00:00' AND ts <= TIMESTAMP '2024-01-28' AND NOT (ts <= TIMESTAMP '2024-01-20' AND event_type <> 'error')")
def a17(t):
    """Errors arrive late: those of the overlap are still unknown, everything else up to the cursor is."""
    known = t.events.where((F.col("ts") <= ntz(LAST)) & (F.col("event_type") != "error")).select("event_id")
    taken = cursor.incremental_slice(t.events, "ts", "event_id", known, LAST, NOW)
    return taken.select("event_id", "user_id", "ts")


@query("a17_backfill_cursor", "SELECT max(ts) AS cursor, count(*) AS taken FROM events WHERE ts >= TIMESTAMP '2024-01-28' - INTERVAL 30 DAYS AND ts <= TIMESTAMP '2024-01-28'")
def a17b(t):
    nothing = t.events.where(F.lit(False)).select("event_id")
    return cursor.next_cursor(cursor.incremental_slice(t.events, "ts", "event_id", nothing, None, NOW), "ts")


@query("a17_stream_from_cursor", """WITH c AS (SELECT max(ts) AS c FROM events WHERE ts <= TIMESTAMP '2024-01-20' AND event_type <> 'error')
    SELECT event_id, user_id, ts FROM events, c WHERE CASE WHEN ts <= TIMESTAMP '2024-01-20' AND event_type <> 'error' THEN ts >= c - INTERVAL 10 DAYS ELSE ts >= c - INTERVAL 6 HOURS END""")
def a17c(t):
    """The first catch-up goes ten days back, the second one takes what has come since; errors come late."""
    base = scratch_path(t.spark, "a17")
    kind = t.events.schema["ts"].dataType
    first = F.coalesce((F.col("ts") <= ntz(LAST)) & (F.col("event_type") != "error"), F.lit(False))
    for arrival in (first, ~first):
        rows = t.events.where(arrival).select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"))
        rows.write.mode("append").parquet(f"{base}/feed")
        sink = ingest.insert_only_sink(f"{base}/store", f"{base}/progress", ["event_id"], (), lambda batch: batch)
        ingest.catch_up(feed.range_stream(t.spark, f"{base}/feed", rows.schema, "ts", backfill="10 days"), sink, f"{base}/progress")
    return sinks.read_store(t.spark, f"{base}/store", rows.schema).select("event_id", "user_id", F.col("ts").cast(kind).alias("ts"))
