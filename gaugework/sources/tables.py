"""Reading tables and checking them before use."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import utc

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Parquet tables of one folder as attributes: ``Tables(spark, dir).events``."""

    def __init__(self, spark: SparkSession, folder: str, names: Iterable[str] = DRIVER_TABLES):
        self.spark, self.folder, self.names = utc(spark), folder.rstrip("/"), tuple(names)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.names:
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)  # later uses share the file listing and schema
        return table


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Raise one error that names every missing catalog table."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise RuntimeError("missing tables: " + ", ".join(missing))


def table_scan(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    require_tables(spark, [name])
    df = spark.table(name)
    return df.select(*columns) if columns else df


def row_ids(spark: SparkSession, n: int, rows_per_task: int = 1_000_000) -> DataFrame:
    """Distributed ids 0..n-1; the number of tasks follows the number of rows."""
    return spark.range(0, n, 1, max(1, -(-n // rows_per_task)))


def literal_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small reference table with a declared schema."""
    return spark.createDataFrame(list(rows), ddl)


def check_columns(df: DataFrame, expected: Sequence[str], name: str = "table") -> DataFrame:
    """Names and order must both match."""
    if df.columns != list(expected):
        raise ValueError(f"{name}: columns {df.columns}, expected {list(expected)}")
    return df


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """``table_name, row_count`` per table, with ``expected_rows, matches`` where expectations are given."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        if expected is not None:
            want = F.lit(expected[name]).cast("long")
            one = one.select("table_name", want.alias("expected_rows"), "row_count", (F.col("row_count") == want).alias("matches"))
        out = one if out is None else out.unionByName(one)
    return out


def require_counts(report: DataFrame) -> None:
    bad = report.where("NOT matches").first()
    if bad is not None:
        raise AssertionError(f"row count of {bad['table_name']}: {bad['row_count']}, expected {bad['expected_rows']}")


def column_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, distinct and null count per column.

    Counting distinct values of many columns in one aggregate would multiply every row by the
    number of columns before the shuffle, so each column is counted by its own aggregate.
    """
    out = None
    for c in columns:
        v = F.col(c)
        one = df.agg(
            F.lit(c).alias("column_name"),
            F.min(v).cast("string").alias("min_value"),
            F.max(v).cast("string").alias("max_value"),
            F.count_distinct(v).alias("distinct_values"),
            F.count_if(v.isNull()).alias("null_values"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def analyze(spark: SparkSession, name: str) -> None:
    """Column statistics for the cost-based optimizer."""
    require_tables(spark, [name])
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def create_tables(spark: SparkSession, database: str, schemas: dict[str, object], replace: bool = False, location: str | None = None) -> None:
    """Empty parquet tables with declared schemas; existing ones stay unless ``replace``. A new database goes to ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, schema in schemas.items():
        full = f"{database}.{name}"
        if replace:
            spark.sql(f"DROP TABLE IF EXISTS {full}")
        elif spark.catalog.tableExists(full):
            continue
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(full)


def ensure_schema(spark: SparkSession, name: str, schema, recreate: bool = False) -> bool:
    """True when the table already has the columns. Otherwise recreate it empty, or raise."""
    wanted = [f.name for f in schema.fields]
    actual = spark.table(name).columns if spark.catalog.tableExists(name) else None
    if actual == wanted:
        return True
    if not recreate:
        raise ValueError(f"{name}: columns {actual}, expected {wanted}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)
    return False
