"""Keys, choices and instants that follow from a number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bounded_key(h, n: int) -> Column:
    """Foreign key in 1..n."""
    if n < 1:
        raise ValueError("a key needs at least one target")
    return F.pmod(_c(h), F.lit(n)) + F.lit(1)


def pick(values: Sequence[str], h) -> Column:
    """One of ``values`` chosen by ``h``."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), bounded_key(h, len(values)).cast("int"))


def moment_after(start_epoch: int, seconds) -> Column:
    return F.timestamp_seconds(F.lit(start_epoch) + _c(seconds).cast("long"))
