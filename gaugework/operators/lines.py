"""Wide rows to calculation lines and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unpivot_lines(
    df: DataFrame, ids: Sequence[str], lines: Sequence[tuple[int, str, int | None]], amount: str = "amount", kind: str | None = "income_type_key"
) -> DataFrame:
    """One output row per (line key, column, optional type key); a narrow operation, no shuffle."""
    entries = []
    for key, column, type_key in lines:
        fields = [F.lit(key).cast("int").alias("tax_line_key")]
        if kind:
            fields.append(F.lit(type_key).cast("int").alias(kind))
        fields.append(F.col(column).cast("decimal(18,2)").alias(amount))
        entries.append(F.struct(*fields))
    return df.select(*ids, F.inline(F.array(*entries)))


def pivot_lines(df: DataFrame, by: Sequence[str], code: str, value: str, names: Mapping[str, Sequence], kind: str = "decimal(18,2)") -> DataFrame:
    """Conditional sums: output column ``name`` totals the rows whose code is listed for it.

    Only rows with a listed code are read; a group without any has no output row.
    """
    needed = sorted({c for codes in names.values() for c in codes})
    picked: list[Column] = [
        F.sum(F.when(F.col(code).isin(list(codes)), F.col(value))).cast(kind).alias(name) for name, codes in names.items()
    ]
    return df.where(F.col(code).isin(needed)).groupBy(*by).agg(*picked)
