"""Column statistics that are kept per batch and combined, without reading earlier batches again.

A batch adds one row per column: counts, bounds, and sketches of distinct values (HyperLogLog), of quantiles (KLL) and
of the most frequent values. Sketches merge by aggregates, so the statistics of a table are those of all its batches
together; a batch that is repeated replaces its own rows. Errors of the estimates: ``DISTINCT_ERROR`` relative (three
standard errors) and ``RANK_ERROR`` of a quantile's rank; a value's count is too low by no more than the estimate's
threshold, and exact while a column has fewer values than the sketch tracks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sinks import PART

HLL_BITS, KLL_SIZE, TRACKED = 12, 200, 1000
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 0.0265
QUANTILES = (0.05, 0.5, 0.95)


def batch_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: name, rows, nulls, bounds and sketches, in one pass over ``df``.

    Quantiles are those of numbers; other columns have an empty quantile sketch.
    """
    numbers = {f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")}

    def of(c: str):
        v, text = F.col(c), F.col(c).cast("string")
        number = v.cast("double") if c in numbers else F.lit(None).cast("double")
        return F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(v.isNull()).alias("nulls"),
            F.min(number).alias("low"),
            F.max(number).alias("high"),
            F.hll_sketch_agg(text, HLL_BITS).alias("distinct_sketch"),
            F.kll_sketch_agg_double(number, KLL_SIZE).alias("quantile_sketch"),
            F.call_function("approx_top_k_accumulate", text, F.lit(TRACKED)).alias("frequent_sketch"),
        )

    return df.agg(F.array(*[of(c) for c in columns]).alias("all")).select(F.inline("all"))


def add_batch(df: DataFrame, columns: Sequence[str], path: str, batch: str) -> None:
    """Store the statistics of a batch; repeated under the same name it replaces them."""
    batch_statistics(df, columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/{PART}={batch}")


def combined(spark: SparkSession, path: str, frequent: int = 5) -> DataFrame:
    """One row per column over all batches: counts, bounds, distinct estimate, quantiles and frequent values."""
    kept = spark.read.parquet(path)
    merged = kept.groupBy("column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_values"),
        F.kll_merge_agg_double("quantile_sketch").alias("_quantiles"),
        F.call_function("approx_top_k_combine", F.col("frequent_sketch"), F.lit(TRACKED)).alias("_frequent"),
    )
    # a sketch without values has no quantiles
    numeric = F.col("low").isNotNull()
    quantiles = F.when(numeric, F.kll_sketch_get_quantile_double("_quantiles", F.array(*[F.lit(q) for q in QUANTILES])))
    top = F.call_function("approx_top_k_estimate", F.col("_frequent"), F.lit(frequent + 1))  # one of them may be null
    top = F.slice(F.filter(top, lambda x: x["item"].isNotNull()), 1, frequent)
    return merged.select("column_name", "rows", "nulls", "low", "high", "distinct_values", quantiles.alias("quantiles"), top.alias("frequent"))
