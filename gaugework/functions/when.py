"""Instants as epoch microseconds: integers order, subtract and bucket exactly."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_UNITS = {
    "microsecond": 1,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def span(text: str) -> int:
    """``"24 hours"`` -> microseconds."""
    found = re.fullmatch(r"\s*(\d+)\s+(microsecond|second|minute|hour|day)s?\s*", text)
    if not found or int(found[1]) == 0:
        raise ValueError(f"not a positive span: {text!r}")
    return int(found[1]) * _UNITS[found[2]]


def micros(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def instant(us: Column, like: str = "timestamp_ntz") -> Column:
    return F.timestamp_micros(us).cast(like)


def whole(us: Column, width: int) -> Column:
    """Floor of ``us / width``; the dividend is an exact multiple, so the quotient is exact."""
    return ((us - F.pmod(us, F.lit(width))) / F.lit(width)).cast("long")


def hours(us: Column) -> Column:
    return us / F.lit(3_600_000_000.0)
