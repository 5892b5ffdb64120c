"""Numeric expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """Null, not zero and not an error, when there is nothing to divide by."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def r6(x) -> Column:
    # + 0.0 turns a negative zero into zero
    return F.round(_c(x).cast("double"), 6) + F.lit(0.0)


def money(x) -> Column:
    return _c(x).cast("decimal(18,2)")


def finite_or_zero(x) -> Column:
    c = _c(x).cast("double")
    broken = c.isNull() | F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.when(broken, F.lit(0.0)).otherwise(c)
