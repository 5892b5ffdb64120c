"""Writing tables: overwrite, append, insert-only merge, cache replacement and layout.

Parquet has no MERGE. A store is a folder of parquet parts in which a merge only ever adds a
part. A part is named by the run and the batch that wrote it: a batch that is replayed within its run
rewrites its own part alone, and no other run, restart or feed can touch it. Beside the parts lie their key
filters and key bounds (``filters``). A merge tests the keys of its batch against them, and reads only those
buckets of those parts in which a key seems to be, to check it exactly: what a batch reads follows the batch and
its overlap with the store, not the number of parts. A filter is written before its part, so that no part is ever
without one; a filter whose part was never finished costs nothing but the test.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators.latest import latest_per_key
from . import filters
from .tables import check_columns

ROWS_PER_FILE = 250_000  # fixed value of the published sizing rule
PART, BUCKET = "batch", "key_bucket"
STORE_BUCKETS = 32  # at most, of one part; a store's creator may name another number
FILTERS = "_filters"


def overwrite_table(df: DataFrame, path: str, expected: Sequence[str] | None = None) -> DataFrame:
    """Replace the folder with files of at most 250k rows after a column check; tasks are balanced by size."""
    if expected is not None:
        check_columns(df, expected, path)
    df.hint("rebalance").write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write with an explicit mode; rows of one partition value are brought together first."""
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError("mode is 'overwrite' or 'errorifexists'")
    if partition_by:
        # a hot partition value is spread over tasks by a rebalance, which AQE may split
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def append_batches(make: Callable[[int, int], DataFrame], total: int, batch: int, path: str, run: str | None = None) -> int:
    """Append ``make(first, rows)`` for consecutive slices; returns the number of batches.

    A slice is written to its own part, named by the run and its number: repeating a lost slice of the same
    ``run`` does not duplicate it, and another call adds its rows to what is there.
    """
    run, done = run or new_run(), 0
    for number, first in enumerate(range(0, total, batch)):
        make(first, min(batch, total - first)).write.mode("overwrite").parquet(f"{path}/{PART}={run}-{number}")
        done += 1
    return done


def read_store(spark: SparkSession, path: str, schema, buckets: bool = False) -> DataFrame:
    """All parts of a store with the part name as column ``batch``; empty when nothing was written."""
    whole = StructType([*schema.fields, StructField(PART, StringType()), *([StructField(BUCKET, IntegerType())] if buckets else [])])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def store_buckets(spark: SparkSession, path: str, wanted: int | None = None) -> int:
    """The most buckets that a part of a store has; noted beside the parts when the store is created."""
    note = f"{path}/_buckets"
    try:
        return int(spark.read.text(note).first()["value"])
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    n = wanted or STORE_BUCKETS
    spark.createDataFrame([(str(n),)], "value string").coalesce(1).write.text(note)
    return n


def read_filters(spark: SparkSession, path: str, key) -> DataFrame:
    """Key filters of all parts, with the part's name; ``key`` is the type of the first key."""
    schema = StructType([*filters.filter_schema(key).fields, StructField(PART, StringType())])
    try:
        return spark.read.schema(schema).parquet(f"{path}/{FILTERS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def new_run() -> str:
    """A name for a run of merges that no other run has."""
    return uuid.uuid4().hex


@dataclass(frozen=True)
class Merged:
    """What a merge did: distinct keys of its batch, rows inserted, and the buckets and parts of the store it read."""

    keys: int
    inserted: int
    buckets_read: int
    parts_read: int


def merge_insert_only(
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    run: str,
    batch: int | str,
    newest_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    null_keys: str = "drop",
    buckets: int | None = None,
) -> Merged:
    """Insert the source rows whose key the store does not hold yet; never update.

    ``run`` names the run (``new_run``, or the id that a stream keeps in its checkpoint) and ``batch`` the
    batch within it. Only a replay of the same batch of the same run rewrites its part; all other parts
    count as known. Within the source the newest row of a key wins; ``columns`` are the ones stored. Rows
    with a null key can never match and would be inserted again by every batch: they are dropped, or
    refused with ``null_keys="error"``.
    Keys that a part's filter and bounds let through are looked up in their bucket of that part; the others are
    new without reading the store. Two runs that merge at the same time may both insert a key: feeds of one
    store take turns.
    """
    spark = source.sparkSession
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    if null_keys == "error" and not source.where(missing).isEmpty():
        raise ValueError("null key in the source")
    part, most, names = f"{run}-{batch}", store_buckets(spark, path, buckets), list(columns or source.columns)
    usable = source.where(~missing)
    fresh = latest_per_key(usable, keys, newest_by, list(dict.fromkeys([*newest_by, *names]))) if newest_by else usable.dropDuplicates(list(keys))
    # the tests and joins read the reduced batch; without the cache each would parse and reduce it again
    fresh = fresh.select(*names).persist()
    cached = [fresh]
    try:
        n, low, high = fresh.agg(F.count(F.lit(1)), F.min(keys[0]), F.max(keys[0])).first()
        stored = read_filters(spark, path, fresh.schema[keys[0]].dataType)
        others = stored.where((F.col(PART) != part) & (F.col(filters.HIGH) >= F.lit(low)) & (F.col(filters.LOW) <= F.lit(high)))
        sizes = [r[0] for r in others.select(filters.BLOCKS).distinct().collect()] if n else []
        new, places = fresh, []
        if sizes:
            suspects = filters.seeming_known(fresh, keys, others, sizes)
            suspects = suspects.select(*keys, PART, F.pmod(filters.BLOCK, filters.BUCKETS).cast("int").alias(BUCKET)).persist()
            cached.append(suspects)
            places = [tuple(r) for r in suspects.select(PART, BUCKET).distinct().collect()]  # at most the files of the store
        if places:
            wanted = F.concat_ws("/", PART, BUCKET).isin([f"{p}/{b}" for p, b in places])
            held = read_store(spark, path, fresh.schema, buckets=True).where(wanted)
            known = held.select(*keys).join(suspects.select(*keys), list(keys), "left_semi")
            new = fresh.join(known, list(keys), "left_anti").persist()
            cached.append(new)
        inserted = new.count() if places else n
        if inserted or not stored.where(F.col(PART) == part).isEmpty():
            blocks, split = filters.block_count(inserted), min(most, max(1, -(-inserted // ROWS_PER_FILE)))
            filters.key_filter(new, keys, blocks, split).write.mode("overwrite").parquet(f"{path}/{FILTERS}/{PART}={part}")
            placed = new.withColumn(BUCKET, F.pmod(filters.block_of(keys, F.lit(blocks)), F.lit(split)).cast("int"))
            placed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/{PART}={part}")
        return Merged(n, inserted, len(places), len({p for p, _ in places}))
    finally:
        for frame in cached:
            frame.unpersist()


def union_insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """The same merge as a query: target rows plus source rows with new keys."""
    kept = source
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    fresh = latest_per_key(kept, keys, newest_by) if newest_by else kept.dropDuplicates(list(keys))
    return target.unionByName(fresh.select(*target.columns).join(target.select(*keys), list(keys), "left_anti"))


def replace_cache(df: DataFrame, path: str, expected_rows: int, key: str) -> DataFrame:
    """Publish a full refresh: written beside the old one, checked, then named current.

    Readers follow the pointer file, so an incomplete refresh leaves the old cache in place.
    """
    spark = df.sparkSession
    version = f"{path}/v-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(version)
    written = spark.read.schema(df.schema).parquet(version)
    seen = written.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k")).first()
    if seen["n"] != expected_rows or seen["k"] != expected_rows:
        raise RuntimeError(f"coverage mismatch: {seen['n']} rows, {seen['k']} keys, expected {expected_rows}")
    pointer = spark.createDataFrame([(version,)], "version string")
    pointer.coalesce(1).write.mode("overwrite").text(f"{path}/current")
    return written


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(spark.read.text(f"{path}/current").first()["value"])


def cluster_layout(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partition and sort on 1 to 4 keys, so that files hold narrow key ranges for skipping.

    Range limits are sampled over all keys together: a hot first key is split by the next ones. The number
    of ranges is the session's, lessened to full ones by adaptive execution.
    """
    if not 1 <= len(keys) <= 4:
        raise ValueError("cluster on one to four keys")
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def interleaved(a, b, bits: int = 31):
    """Bit-interleaved key of two integers from 0 to 2**bits - 1, for layouts on two columns; others are an error."""
    top = F.lit((1 << bits) - 1)
    out = F.lit(0).cast("long")
    for i in range(bits):
        for shift, c in ((2 * i, a), (2 * i + 1, b)):
            bit = F.shiftright(c.cast("long"), i).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, shift))
    outside = (a < 0) | (b < 0) | (a > top) | (b > top)
    return F.when(outside, F.raise_error(F.lit(f"keys beyond {bits} bits")).cast("long")).otherwise(out)


def spread(df: DataFrame, column: str) -> DataFrame:
    """Bring the rows of a value together before a write; large values are split by size, small ones joined."""
    return df.hint("rebalance", column)
