"""Hilbert layout of files over several keys, and how many files a box of key ranges needs.

Each key is first replaced by its rank among equal-count ranges (from approximate percentiles), so that skewed or
far-apart values use the whole curve; nulls come first. Neighbours on the curve are neighbours in every key, so a
file holds a compact box, and the bounds of files let a reader skip most of them for a filter on any of the keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

RANK_BITS = 8
MOST_KEYS = 5  # whose step tables have 5120 entries
RANKED = ("byte", "short", "integer", "long", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz")


def equal_count_rank(value: Column, cuts: Sequence, bits: int) -> Column:
    """Number of cuts up to the value, by binary search in 2**bits - 1 sorted cuts; null is 0."""
    held = F.array(*[F.lit(c) for c in cuts])
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(bits))])
    rank = F.aggregate(halves, F.lit(0), lambda at, half: at + F.when(value >= F.element_at(held, at + half), half).otherwise(0))
    return F.when(value.isNull(), F.lit(0)).otherwise(rank)


def curve_steps(n: int) -> tuple[list[int], list[int]]:
    """Of the curve in ``n`` dimensions, for each state and corner of a cube: the corner's place, and the state within it.

    A state is the corner where the curve enters and the direction in which it leaves, entry * n + direction. Corners
    follow the Gray code; the cube at a place is entered and left so that the next one begins beside it.
    """
    size = 1 << n

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    def turned(x: int, by: int) -> int:
        by %= n
        return ((x << by) | (x >> (n - by))) & (size - 1)

    def ones(i: int) -> int:  # trailing ones
        return ((~i & (i + 1)).bit_length() - 1) % n

    back = {gray(i): i for i in range(size)}
    places, states = [], []
    for entry in range(size):
        for direction in range(n):
            for corner in range(size):
                w = back[turned(corner ^ entry, n - (direction + 1) % n)]
                enters = gray(2 * ((w - 1) // 2)) if w else 0
                leaves = 0 if not w else ones(w - 1) if w % 2 == 0 else ones(w)
                places.append(w)
                states.append((entry ^ turned(enters, direction + 1)) * n + (direction + leaves + 1) % n)
    return places, states


def hilbert(coordinates: Sequence[Column], bits: int) -> Column:
    """Place on the Hilbert curve of integers from 0 to 2**bits - 1: one table step for each bit, the highest first."""
    n = len(coordinates)
    if n * bits > 62 or n > MOST_KEYS:
        raise ValueError(f"more than {MOST_KEYS} coordinates, or more bits than a place can hold")
    places, states = (F.array(*[F.lit(x) for x in table]) for table in curve_steps(n))
    levels = F.array(*[F.lit(b) for b in reversed(range(bits))])

    def step(at: Column, level: Column) -> Column:
        corner = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.call_function("shiftright", c.cast("int"), level).bitwiseAND(F.lit(1)), i) for i, c in enumerate(coordinates)])
        entry = at["state"] * (1 << n) + corner + 1
        return F.struct((at["h"] * (1 << n) + F.element_at(places, entry)).alias("h"), F.element_at(states, entry).alias("state"))

    return F.aggregate(levels, F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("state")), step, lambda at: at["h"])


def hilbert_layout(df: DataFrame, keys: Sequence[str], files: int, bits: int = RANK_BITS) -> DataFrame:
    """``df`` in ``files`` partitions along the Hilbert curve over numbers, dates or instants, ready to be written."""
    for k in keys:
        if df.schema[k].dataType.typeName().split("(")[0] not in RANKED:
            raise ValueError(f"{k} has no percentiles")
    bits = min(bits, 62 // len(keys))
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    # at most 2**bits - 1 numbers a key; a column without values has no cuts
    found = df.agg(*[F.percentile_approx(k, shares, 10_000).alias(f"c{i}") for i, k in enumerate(keys)]).first()
    ranks = [equal_count_rank(F.col(k), cuts, bits) if cuts else F.lit(0) for k, cuts in zip(keys, found, strict=True)]
    at = "_place_on_curve"
    return df.withColumn(at, hilbert(ranks, bits)).repartitionByRange(files, at).sortWithinPartitions(at).drop(at)


def file_bounds(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest and highest value of each key by file of a stored table."""
    return stored.groupBy(F.input_file_name().alias("file")).agg(*[f(k).alias(f"{k}_{n}") for k in keys for f, n in ((F.min, "low"), (F.max, "high"))])


def files_needed(bounds: DataFrame, boxes: Mapping[str, Mapping[str, tuple]]) -> DataFrame:
    """box, files, needed, share: files whose bounds meet each box of key ranges (both ends included)."""
    tests = []
    for name, box in boxes.items():
        meets = F.lit(True)
        for k, (low, high) in box.items():
            meets = meets & (F.col(f"{k}_high") >= F.lit(low)) & (F.col(f"{k}_low") <= F.lit(high))
        tests.append(F.struct(F.lit(name).alias("box"), F.count(F.lit(1)).alias("files"), F.count_if(meets).alias("needed")))
    rows = bounds.agg(F.array(*tests).alias("all")).select(F.inline("all"))
    return rows.withColumn("share", F.col("needed") / F.col("files"))
