"""As-of, range, stab and neighbour operators on instants and intervals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.when import hours, instant, micros, span, whole
from .scan import AT, attach, cell_of, key_pairs, keyed, prefix_scan, scan_keys, slot_of

OPEN_END = 9_223_372_036_854_775_807  # an interval without an end outlasts every instant


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def as_of_latest(
    left: DataFrame,
    right: DataFrame,
    on,
    left_ts: str,
    right_ts: str,
    values: Mapping[str, str] | Sequence[str] = (),
    tie: Sequence[str] = (),
    strict: bool = False,
    matched: str | None = None,
    cell: str = "1 day",
) -> DataFrame:
    """Each left row with the latest right row at or before (``strict``: before) its instant.

    ``values`` maps output names to right columns. Among right rows of one instant the highest
    ``tie`` columns win. ``matched`` names the time of the row found; null where there is none.
    """
    pairs = key_pairs(on)
    names = dict(values) if isinstance(values, Mapping) else {v: v for v in values}
    payload = F.struct(
        micros(right_ts).alias("us"),
        *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)],
        *[F.col(c).alias(f"v{i}") for i, c in enumerate(names.values())],
    )
    lk, rk = [p[0] for p in pairs], [p[1] for p in pairs]
    found = prefix_scan(
        keyed(right, rk, micros(right_ts), _top=payload),
        keyed(left, lk, micros(left_ts)),
        scan_keys(pairs),
        span(cell),
        tops=["_top"],
        strict=strict,
    )
    take: dict[str, Column] = {n: F.col(f"_top.v{i}") for i, n in enumerate(names)}
    if matched:
        take[matched] = instant(F.col("_top.us"), _kind(right, right_ts))
    return attach(left, found, lk, micros(left_ts), take)


def count_in_window(
    left: DataFrame,
    right: DataFrame,
    on,
    left_ts: str,
    right_ts: str,
    back: str,
    name: str = "events_in_window",
    closed: str = "[)",
    cell: str = "1 day",
) -> DataFrame:
    """Number of right rows in the window that ends at each left instant.

    A window count is the difference of two running counts, so no pair of rows is ever formed.
    """
    if closed not in ("[)", "(]"):
        raise ValueError("closed is '[)' or '(]'")
    pairs = key_pairs(on)
    lk, rk = [p[0] for p in pairs], [p[1] for p in pairs]
    keys = scan_keys(pairs)
    width = span(back)
    bounds = keyed(left, lk, micros(left_ts)).select(
        *keys, F.explode(F.array(F.col(AT), F.col(AT) - F.lit(width))).alias(AT)
    )
    counts = prefix_scan(
        keyed(right, rk, micros(right_ts), _n=F.lit(1).cast("long")),
        bounds,
        keys,
        span(cell),
        sums=["_n"],
        strict=closed == "[)",
    )
    # an instant may end one window and begin another, so every count is offered to both
    ends = counts.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col(AT).alias("at"), F.col("_n").alias("n"), F.lit(True).alias("upper")),
                F.struct((F.col(AT) + F.lit(width)).alias("at"), (-F.col("_n")).alias("n"), F.lit(False).alias("upper")),
            )
        ).alias("e"),
    )
    found = (
        ends.groupBy(*keys, F.col("e.at").alias(AT))
        .agg(F.sum("e.n").alias("_n"), F.count_if(F.col("e.upper")).alias("_u"), F.count_if(~F.col("e.upper")).alias("_l"))
        .where((F.col("_u") == 1) & (F.col("_l") == 1))
    )
    return attach(left, found, lk, micros(left_ts), {name: F.coalesce(F.col("_n"), F.lit(0)).cast("long")})


def first_after(
    left: DataFrame,
    right: DataFrame,
    on,
    left_ts: str,
    right_ts: str,
    horizon: str | None = None,
    horizon_end: str | None = None,
    name: str = "next_time",
    closed: str = "(]",
    cell: str = "1 day",
) -> DataFrame:
    """Time of the first right row after each left instant, no later than its horizon.

    ``closed="[]"`` also accepts the left instant itself. The horizon is a span or a column
    holding its end.
    """
    if closed not in ("(]", "[]"):
        raise ValueError("closed is '(]' or '[]'")
    if (horizon is None) == (horizon_end is None):
        raise ValueError("give either horizon or horizon_end")
    pairs = key_pairs(on)
    lk, rk = [p[0] for p in pairs], [p[1] for p in pairs]
    found = prefix_scan(
        keyed(right, rk, micros(right_ts), _late=-micros(right_ts)),
        keyed(left, lk, micros(left_ts)),
        scan_keys(pairs),
        span(cell),
        tops=["_late"],
        strict=closed == "(]",
        backward=True,
    )
    limit = micros(left_ts) + F.lit(span(horizon)) if horizon else micros(horizon_end)
    nearest = -F.col("_late")
    return attach(
        left, found, lk, micros(left_ts), {name: F.when(nearest <= limit, instant(nearest, _kind(right, right_ts)))}
    )


def time_to_next(
    left: DataFrame, right: DataFrame, on, left_ts: str, right_ts: str, within: str, name: str = "seconds_to_next", cell: str = "1 day"
) -> DataFrame:
    """Seconds from each left instant to the next right row within ``within``; an equal instant gives 0."""
    near = first_after(left, right, on, left_ts, right_ts, horizon=within, name="_next", closed="[]", cell=cell)
    gap = (micros("_next") - micros(left_ts)) / F.lit(1_000_000.0)
    return near.withColumn(name, gap).drop("_next")


def stab(
    left: DataFrame,
    intervals: DataFrame,
    on,
    at: str,
    start: str,
    end: str,
    values: Mapping[str, str],
    tie: Sequence[str] = (),
    default: Mapping[str, str] | None = None,
    covering: str | None = None,
    cell: str = "1 day",
) -> DataFrame:
    """The interval ``[start, end)`` that covers each left instant; a null end is open.

    Where several cover it, the one that ends last (then starts last, then highest ``tie``) is
    shown, and ``covering`` counts them all so that an overlap stays visible. Intervals that do
    not end after they start cover nothing.
    """
    pairs = key_pairs(on)
    lk, rk = [p[0] for p in pairs], [p[1] for p in pairs]
    begins, ends = micros(start), F.coalesce(micros(end), F.lit(OPEN_END))
    valid = intervals.where(begins < ends)
    payload = F.struct(
        ends.alias("until"),
        begins.alias("since"),
        *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)],
        *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())],
    )
    edges = keyed(valid, rk, begins, _top=payload, _open=F.lit(1).cast("long"))
    if covering:
        closing = keyed(valid.where(F.col(end).isNotNull()), rk, micros(end), _open=F.lit(-1).cast("long"))
        edges = edges.unionByName(closing, allowMissingColumns=True)
    found = prefix_scan(edges, keyed(left, lk, micros(at)), scan_keys(pairs), span(cell), tops=["_top"], sums=["_open"])
    hit = F.col("_top.until") > micros(at)
    take: dict[str, Column] = {}
    for i, name in enumerate(values):
        value = F.when(hit, F.col(f"_top.v{i}"))
        fallback = (default or {}).get(name)
        take[name] = value if fallback is None else F.coalesce(value, F.lit(fallback))
    if covering:
        take[covering] = F.coalesce(F.col("_open"), F.lit(0)).cast("long")
    return attach(left, found, lk, micros(at), take)


def covering_at(
    intervals: DataFrame, keys: Sequence[str], start: str, end: str, as_of: Column, values: Mapping[str, str], tie: Sequence[str] = ()
) -> DataFrame:
    """One row per key that some interval covers at a fixed instant, with the number that do.

    The same choice as ``stab``, but a filter and one aggregate suffice for a single instant.
    """
    asked = micros(as_of)
    begins, ends = micros(start), F.coalesce(micros(end), F.lit(OPEN_END))
    best = F.max(
        F.struct(
            ends.alias("until"),
            begins.alias("since"),
            *[F.col(t).alias(f"t{i}") for i, t in enumerate(tie)],
            *[F.col(c).alias(f"v{i}") for i, c in enumerate(values.values())],
        )
    ).alias("_best")
    return (
        intervals.where((begins <= asked) & (ends > asked))
        .groupBy(*keys)
        .agg(best, F.count(F.lit(1)).alias("covering"))
        .select(*keys, *[F.col(f"_best.v{i}").alias(n) for i, n in enumerate(values)], "covering")
    )


def clip(intervals: DataFrame, start: str, end: str, lo: Column, hi: Column) -> DataFrame:
    """Intervals cut to ``[lo, hi)``; an open end runs to ``hi`` and empty remainders are dropped."""
    kind = _kind(intervals, start)
    a = F.greatest(micros(start), micros(lo))
    b = F.least(F.coalesce(micros(end), F.lit(OPEN_END)), micros(hi))
    return (
        intervals.withColumns({"_a": a, "_b": b})
        .where(F.col("_b") > F.col("_a"))
        .withColumns(
            {
                "clipped_start": instant(F.col("_a"), kind),
                "clipped_end": instant(F.col("_b"), kind),
                "hours": hours(F.col("_b") - F.col("_a")),
            }
        )
        .drop("_a", "_b")
    )


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    previous: Mapping[str, str] | None = None,
    following: Mapping[str, str] | None = None,
    reach: Mapping[str, Column] | None = None,
    cell: str = "1 day",
) -> DataFrame:
    """Columns of the previous and next row of the same key in the order (``ts``, ``order``).

    ``reach`` adds running maxima over all earlier rows. Windows run per (key, slot of a time cell); what
    lies before and after comes from one summary row per slot within the cell and one per cell. ``order``
    must make the rows of an instant distinct.
    """
    keys, previous, following, reach = list(keys), dict(previous or {}), dict(following or {}), dict(reach or {})
    spot = F.struct(micros(ts).alias("us"), *[F.col(o).alias(f"o{i}") for i, o in enumerate(order)])
    wanted = {**{f"p{i}": c for i, c in enumerate(previous.values())}, **{f"f{i}": c for i, c in enumerate(following.values())}}
    base = df.withColumns(
        {
            "_slot": slot_of(micros(ts), span(cell)),
            "_spot": spot,
            "_row": F.struct(spot.alias("spot"), *[F.col(c).alias(n) for n, c in wanted.items()]),
            **{f"_r{i}": c for i, c in enumerate(reach.values())},
        }
    )
    inside = Window.partitionBy(*keys, "_slot").orderBy("_spot")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    reaches = range(len(reach))
    local = base.withColumns(
        {
            "_prev": F.lag("_row").over(inside),
            "_next": F.lead("_row").over(inside),
            **{f"_m{i}": F.max(f"_r{i}").over(before) for i in reaches},
        }
    )
    edges = [F.min("_first").alias("_first"), F.max("_last").alias("_last"), *[F.max(f"_r{i}").alias(f"_r{i}") for i in reaches]]
    slots = base.withColumns({"_first": F.col("_row"), "_last": F.col("_row")}).groupBy(*keys, "_slot").agg(*edges).withColumn("_cell", cell_of(F.col("_slot")))
    cells = slots.groupBy(*keys, "_cell").agg(*edges)

    def carried(rows: DataFrame, part: Sequence[str], by: str, tag: str, *kept: str) -> DataFrame:
        """What lies before and after each summary row of its part."""
        w = Window.partitionBy(*keys, *part).orderBy(by)
        earlier = w.rowsBetween(Window.unboundedPreceding, -1)
        return rows.select(
            *[F.col(k).alias(f"{tag}_{k}") for k in keys],
            *[F.col(k).alias(f"{tag}{k}") for k in kept],
            F.lag("_last").over(w).alias(f"{tag}_prev"),
            F.lead("_first").over(w).alias(f"{tag}_next"),
            *[F.max(f"_r{i}").over(earlier).alias(f"{tag}_m{i}") for i in reaches],
        )

    def same(left: str, right: str, column: str, other: str) -> Column:
        match = F.col(column) == F.col(other)
        for k in keys:
            match = match & F.col(f"{left}{k}").eqNullSafe(F.col(f"{right}_{k}"))
        return match

    within, across = carried(slots, ["_cell"], "_slot", "_s", "_slot", "_cell"), carried(cells, [], "_cell", "_c", "_cell")
    both = within.join(across, same("_s_", "_c", "_s_cell", "_c_cell"), "left")
    out = local.join(both, same("", "_s", "_slot", "_s_slot"), "left")
    prev, nxt = F.coalesce("_prev", "_s_prev", "_c_prev"), F.coalesce("_next", "_s_next", "_c_next")
    return out.select(
        *[F.col(c) for c in df.columns],
        *[prev.getField(f"p{i}").alias(n) for i, n in enumerate(previous)],
        *[nxt.getField(f"f{i}").alias(n) for i, n in enumerate(following)],
        *[F.greatest(f"_m{i}", f"_s_m{i}", f"_c_m{i}").alias(n) for i, n in enumerate(reach)],
    )


def interval_issues(intervals: DataFrame, keys: Sequence[str], start: str, end: str, ident: str) -> DataFrame:
    """Overlaps, uncovered gaps and invalid intervals per key: ``keys, kind, issue_start, issue_end``.

    Invalid intervals (end not after start) are reported and take no part in the other checks.
    An overlap runs from an interval's start to the end it shares with what came before; a gap
    runs from the furthest end so far to the next start.
    """
    kind = _kind(intervals, start)
    begins, ends = micros(start), F.coalesce(micros(end), F.lit(OPEN_END))
    invalid = intervals.where(begins >= ends).select(
        *keys, F.lit("invalid").alias("kind"), F.col(start).alias("issue_start"), F.col(end).alias("issue_end")
    )
    chained = with_neighbours(intervals.where(begins < ends), keys, start, [ident], reach={"_reach": ends})
    mine, reach = micros(start), F.col("_reach")
    broken = chained.where(reach.isNotNull() & (reach != mine)).select(
        *keys,
        F.when(reach > mine, F.lit("overlap")).otherwise(F.lit("gap")).alias("kind"),
        F.least(reach, mine).alias("_lo"),
        F.greatest(reach, mine).alias("_hi"),
        ends.alias("_end"),
    )
    over = F.col("kind") == "overlap"
    stop = F.when(over, F.least("_hi", "_end")).otherwise(F.col("_hi"))
    return broken.select(
        *keys,
        "kind",
        instant(F.col("_lo"), kind).alias("issue_start"),
        F.when(stop < F.lit(OPEN_END), instant(stop, kind)).alias("issue_end"),
    ).unionByName(invalid)
