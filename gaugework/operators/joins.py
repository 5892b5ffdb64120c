"""Join helpers that keep the fact grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut

@dataclass(frozen=True)
class Dimension:
    """A lookup table with a unique key, joined to ``fact_key`` of the fact or of ``via``."""

    table: DataFrame
    key: str
    fact_key: str
    columns: Mapping[str, str] = field(default_factory=dict)  # output name -> column
    via: str | None = None


def star(fact: DataFrame, dimensions: Mapping[str, Dimension], wanted: Sequence[str]) -> DataFrame:
    """Fact columns plus the wanted dimension columns; dimensions nobody asked for are not joined."""
    owner = {out: name for name, d in dimensions.items() for out in d.columns}
    needed: list[str] = []

    def need(name: str) -> None:
        if dimensions[name].via:
            need(dimensions[name].via)
        if name not in needed:
            needed.append(name)

    for w in wanted:
        if w in owner:
            need(owner[w])
        elif w not in fact.columns:
            raise ValueError(f"unknown column {w}")
    out = fact
    for name in needed:
        d = dimensions[name]
        steps = [x.fact_key for x in dimensions.values() if x.via == name]
        extra = [s for s in dict.fromkeys(steps) if s not in d.columns and s not in out.columns and s in d.table.columns]
        look = d.table.select(
            F.col(d.key).alias(f"_key_{name}"), *[F.col(c).alias(o) for o, c in d.columns.items()], *extra
        )
        out = out.join(look, F.col(d.fact_key) == F.col(f"_key_{name}"), "left").drop(f"_key_{name}")
    return out.select(*wanted)


def having_any(df: DataFrame, detail: DataFrame, key: str, detail_key: str) -> DataFrame:
    """Rows of ``df`` with at least one detail row; several matches do not repeat a row.

    The details are reduced to distinct keys first, so a hot key is not sent to one task.
    """
    found = detail.select(F.col(detail_key).alias("_dk")).distinct()
    return df.join(found, F.col(key) == F.col("_dk"), "left_semi")


def having_none(df: DataFrame, detail: DataFrame, key: str, detail_key: str) -> DataFrame:
    """Rows of ``df`` without any detail row."""
    found = detail.select(F.col(detail_key).alias("_dk")).distinct()
    return df.join(found, F.col(key) == F.col("_dk"), "left_anti")


def filter_ids(df: DataFrame, **allowed: Sequence | DataFrame | None) -> DataFrame:
    """Multi-select filters; None leaves a column open, a one-column DataFrame filters by semi join."""
    for column, ids in allowed.items():
        if ids is None:
            continue
        if isinstance(ids, DataFrame):
            df = having_any(df, ids, column, ids.columns[0])
        else:
            df = df.where(F.col(column).isin(list(ids)))
    return df


def search(df: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """Case-insensitive substring search in any of the columns."""
    needle = F.lit(text.lower())
    hit: Column = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(F.col(c).cast("string")), needle), F.lit(False))
    return df.where(hit)


def fan_out(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows, rows of the left join, and whether the join keeps the left grain.

    Both counts come from the per-key counts of the two sides, so the join itself is never built.
    """
    l = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_l"))
    r = right.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_r"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_{k}"))
    both = l.join(r, cond, "left")
    joined = F.sum(F.col("_l") * F.greatest(F.coalesce("_r", F.lit(0)), F.lit(1))).cast("long")
    return both.agg(F.sum("_l").cast("long").alias("left_rows"), joined.alias("joined_rows")).withColumn(
        "keeps_grain", F.col("left_rows") == F.col("joined_rows")
    )


def ancestors(df: DataFrame, ident: str, parent: str, max_depth: int | None = None) -> DataFrame:
    """(node, ancestor, depth) for every ancestor of every node, by pointer doubling.

    After k rounds all ancestors up to a distance of 2**k are known, and every node points 2**k up; a round joins
    these pointers with what is known, so a hierarchy of depth n takes log2(n) rounds, each cut with a checkpoint.
    A cycle ends in an error as soon as one of its nodes reaches itself, and so does a depth beyond ``max_depth``.
    """
    up = df.where(F.col(parent).isNotNull()).select(F.col(ident).alias("node"), F.col(parent).alias("ancestor"), F.lit(1).alias("depth"))
    found = longer = cut(up)
    step = 1
    while True:
        if (circular := longer.where("node = ancestor").first()) is not None:
            raise ValueError(f"{circular['node']} is its own ancestor, {circular['depth']} levels up")
        pointers = longer.where(F.col("depth") == step).select("node", F.col("ancestor").alias("_at"))
        known = found.select(F.col("node").alias("_at"), "ancestor", "depth")
        longer = cut(pointers.join(known, "_at").select("node", "ancestor", (F.col("depth") + step).alias("depth")))
        if longer.isEmpty():
            return found
        if max_depth is not None and not longer.where(F.col("depth") > max_depth).isEmpty():
            raise ValueError(f"hierarchy deeper than {max_depth} levels")
        found = found.unionByName(longer)
        step *= 2


def roots(df: DataFrame, ident: str, parent: str) -> DataFrame:
    """(node, root, depth) for every node: its topmost ancestor and how far up it is, itself at 0.

    The same doubling with one pointer per node, for hierarchies whose pairs would be too many to list.
    """
    known = F.col(parent).isNotNull()
    rows = cut(df.select(F.col(ident).alias("node"), F.when(known, F.col(parent)).otherwise(F.col(ident)).alias("root"), known.cast("long").alias("depth")))
    n, total = rows.agg(F.count(F.lit(1)), F.sum("depth")).first()
    while True:
        above = rows.select(F.col("node").alias("_at"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        joined = rows.join(above, F.col("root") == F.col("_at"), "left")
        rows = cut(joined.select("node", F.coalesce("_root", "root").alias("root"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")))
        if (circular := rows.where(F.col("depth") > n).first()) is not None:  # further up than there are nodes
            raise ValueError(f"a cycle above {circular['node']}")
        before, total = total, rows.agg(F.sum("depth")).first()[0]
        if total == before:
            return rows
