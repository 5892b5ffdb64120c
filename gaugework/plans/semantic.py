"""Metric definitions: a source, lookups, named dimensions and measures, compiled to one aggregate."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.when import span


@dataclass(frozen=True)
class Lookup:
    """A joined table. ``on`` is a condition over ``source.`` and earlier lookups' columns.

    ``unique`` declares that the key has at most one row; such a left join can be left out when no
    requested expression mentions it.
    """

    table: DataFrame
    on: str
    how: str = "left"
    unique: bool = True


@dataclass(frozen=True)
class MetricView:
    source: DataFrame
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    lookups: Mapping[str, Lookup] = field(default_factory=dict)
    filter: str | None = None


def _mentions(text: str, name: str) -> bool:
    return re.search(rf"(?<![\w.]){re.escape(name)}\.", text) is not None


def needed_lookups(view: MetricView, texts: Sequence[str]) -> list[str]:
    """Lookups that the expressions mention, directly or through another lookup's condition."""
    keep, open_texts = set(), list(texts)
    for name, look in view.lookups.items():
        if look.how != "left" or not look.unique:
            keep.add(name)
            open_texts.append(look.on)
    while open_texts:
        text = open_texts.pop()
        for name, look in view.lookups.items():
            if name not in keep and _mentions(text, name):
                keep.add(name)
                open_texts.append(look.on)
    return [n for n in view.lookups if n in keep]


def metric_query(view: MetricView, dimensions: Sequence[str], measures: Sequence[str], where: str | None = None) -> DataFrame:
    """The requested measures by the requested dimensions; unused lookups are not joined."""
    for name, known in [*((d, view.dimensions) for d in dimensions), *((m, view.measures) for m in measures)]:
        if name not in known:
            raise ValueError(f"unknown field {name}")
    dims = {d: view.dimensions[d] for d in dimensions}
    texts = [*dims.values(), *(view.measures[m] for m in measures), view.filter or "", where or ""]
    out = view.source.alias("source")
    for name in needed_lookups(view, texts):
        look = view.lookups[name]
        out = out.join(look.table.alias(name), F.expr(look.on), look.how)
    for condition in (view.filter, where):
        if condition:
            out = out.where(F.expr(condition))
    return out.groupBy(*[F.expr(e).alias(d) for d, e in dims.items()]).agg(*[F.expr(view.measures[m]).alias(m) for m in measures])


def for_user(parent: DataFrame, grants: DataFrame, user: str, column: str) -> DataFrame:
    """Rows of the shared parent a user may see; the parent itself stays unfiltered."""
    mine = grants.where(F.col("user_name") == user).select(F.col(column).alias("_granted"))
    return parent.join(mine, F.col(column) == F.col("_granted"), "left_semi")


def recent(parent: DataFrame, ts: str, now: datetime, window: str) -> DataFrame:
    """The relative-date child of a stored parent: rows of the last ``window`` before ``now``."""
    kind = parent.schema[ts].dataType.simpleString()
    start = now - timedelta(microseconds=span(window))
    return parent.where((F.col(ts) >= F.lit(start).cast(kind)) & (F.col(ts) < F.lit(now).cast(kind)))


def detail(df: DataFrame, required: Mapping[str, Sequence | None]) -> DataFrame:
    """A detail query that refuses to run without its mandatory filters."""
    missing = [c for c, v in required.items() if not v]
    if missing:
        raise ValueError("required filters: " + ", ".join(missing))
    keep: Column = F.lit(True)
    for c, v in required.items():
        keep = keep & F.col(c).isin(list(v))
    return df.where(keep)


def drill(lines: DataFrame, catalogue: DataFrame, return_id) -> DataFrame:
    """The line trail of one return, given by value or scalar subquery, in calculation order."""
    named = catalogue.select("tax_line_key", "tax_line_code", "line_sequence")
    picked = lines.where(F.col("return_id") == return_id).join(named, "tax_line_key")
    return picked.select("return_id", "line_sequence", "tax_line_code", "amount").orderBy("line_sequence")
