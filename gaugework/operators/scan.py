"""Running aggregates over time, per key, that do not put a key into one task.

Every point-in-time operator asks the same thing: what do the rows up to an instant amount to?
A window partitioned by the key alone would answer it with the whole history of a hot key in one
task. Here time is cut twice instead, into cells and each cell into ``FAN`` slots:

1. rows of one (key, instant) are merged first, with map-side combine;
2. a window per (key, slot) runs over the distinct instants of that slot;
3. one summary row per (key, slot) carries the state on within the cell, in a window of at most
   ``FAN`` rows;
4. one summary row per (key, cell) carries it on into later cells, in a window of at most
   (time span / cell width) rows per key.

So a burst of one key within minutes is spread over many tasks, however many rows it has. The
results do not depend on the widths; they only balance the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.when import whole

AT, SLOT, CELL, PROBE = "_at", "_slot", "_cell", "_probe"
FAN = 1024  # slots of a cell


def slot_of(at: Column, cell: int) -> Column:
    """Number of the slot that holds an instant, for cells of ``cell`` microseconds."""
    return whole(at, max(1, cell // FAN))


def cell_of(slot: Column) -> Column:
    return whole(slot, FAN)


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def prefix_scan(
    events: DataFrame,
    probes: DataFrame,
    keys: Sequence[str],
    cell: int,
    tops: Sequence[str] = (),
    sums: Sequence[str] = (),
    strict: bool = False,
    backward: bool = False,
) -> DataFrame:
    """Maximum of each ``tops`` column and total of each ``sums`` column up to each probe.

    Both inputs hold ``keys`` and ``_at`` (epoch microseconds). ``strict`` leaves out rows at the
    probe's own instant; ``backward`` scans from late to early. Returns one row per distinct
    probe instant. Rows with a null key or instant take no part.
    """
    keys = list(keys)
    known = F.col(AT).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    order = -F.col(AT) if backward else F.col(AT)

    rows = events.where(known).select(*keys, order.alias(AT), *tops, *sums, F.lit(False).alias(PROBE))
    asks = probes.where(known).select(*keys, order.alias(AT), F.lit(True).alias(PROBE))
    merged = (
        rows.unionByName(asks, allowMissingColumns=True)
        .withColumn(SLOT, slot_of(F.col(AT), cell))
        .groupBy(*keys, SLOT, AT)
        .agg(F.max(PROBE).alias(PROBE), *_summary(tops, sums))
    )

    def upto(rows: DataFrame, part: Sequence[str], by: str, last: int, prefix: str, *kept: str) -> DataFrame:
        """State up to each row of its part; only rows with a probe are wanted further on."""
        w = Window.partitionBy(*keys, *part).orderBy(by).rowsBetween(Window.unboundedPreceding, last)
        state = [F.max(c).over(w).alias(prefix + c) for c in tops] + [F.sum(c).over(w).alias(prefix + c) for c in sums]
        return rows.select(*keys, *kept, PROBE, *state).where(PROBE).drop(PROBE)

    slots = merged.groupBy(*keys, SLOT).agg(F.max(PROBE).alias(PROBE), *_summary(tops, sums)).withColumn(CELL, cell_of(F.col(SLOT)))
    cells = slots.groupBy(*keys, CELL).agg(F.max(PROBE).alias(PROBE), *_summary(tops, sums))
    local = upto(merged, [SLOT], AT, -1 if strict else 0, "", SLOT, AT)
    within = upto(slots, [CELL], SLOT, -1, "_in_", SLOT, CELL)
    across = upto(cells, [], CELL, -1, "_over_", CELL)
    at = -F.col(AT) if backward else F.col(AT)
    # every slot and cell with a probe has its summary row; left joins keep the branches on their exchanges
    carried = within.join(across, [*keys, CELL], "left").drop(CELL)
    return local.join(carried, [*keys, SLOT], "left").select(
        *keys,
        at.alias(AT),
        *[F.greatest(c, f"_in_{c}", f"_over_{c}").alias(c) for c in tops],
        *[_plus(F.col(c), _plus(F.col(f"_in_{c}"), F.col(f"_over_{c}"))).alias(c) for c in sums],
    )


def _summary(tops: Sequence[str], sums: Sequence[str]) -> list[Column]:
    return [F.max(c).alias(c) for c in tops] + [F.sum(c).alias(c) for c in sums]


def key_pairs(on) -> list[tuple[str, str]]:
    """``"k"``, ``["k", ("left_k", "right_k")]`` -> pairs of column names."""
    on = [on] if isinstance(on, (str, tuple)) else list(on)
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def scan_keys(pairs) -> list[str]:
    return [f"_k{i}" for i in range(len(pairs))]


def keyed(df: DataFrame, columns: Sequence[str], at: Column, **extra: Column) -> DataFrame:
    """Projection of ``df`` to the neutral names the scan uses."""
    return df.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)],
        at.alias(AT),
        *[c.alias(name) for name, c in extra.items()],
    )


def attach(left: DataFrame, found: DataFrame, columns: Sequence[str], at: Column, take: dict[str, Column]) -> DataFrame:
    """Join scan results back to every row of ``left``; rows without a key keep nulls."""
    tagged = left.withColumn("_ask", at)
    match = [F.col(c) == F.col(f"_k{i}") for i, c in enumerate(columns)] + [F.col("_ask") == F.col(AT)]
    joined = tagged.join(found, reduce(lambda a, b: a & b, match), "left")
    return joined.select(*[F.col(c) for c in left.columns], *[c.alias(n) for n, c in take.items()])
