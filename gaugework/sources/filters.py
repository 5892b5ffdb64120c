"""Key filters of stored parts: split-block Bloom filters and key bounds, built by an aggregate, kept as a table.

A key falls into one block of 256 bits and sets one bit in each of its eight words, so a filter is one row per
block and building it is a grouped OR with map-side combine. A test joins keys and filters on the block number. Blocks
are a power of two in number, with some 20 to 40 bits a key: about one unknown key in ten thousand seems known.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StructField, StructType

WORDS, WORD_BITS, BITS_PER_KEY = 8, 32, 20
LEAST_BLOCKS = 64  # the keys of a large batch meet the filters of small parts in at least so many groups
BLOCKS, BLOCK, BUCKETS, LOW, HIGH = "_blocks", "_block", "_buckets", "_low", "_high"
_WORD = [f"_word{i}" for i in range(WORDS)]


def block_count(rows: int) -> int:
    wanted, n = rows * BITS_PER_KEY / (WORDS * WORD_BITS), LEAST_BLOCKS
    while n < wanted:
        n *= 2
    return n


def filter_schema(key: DataType) -> StructType:
    """Columns of a stored filter; bounds are those of the first key."""
    words = [StructField(w, IntegerType()) for w in _WORD]
    counts = [StructField(BLOCKS, LongType()), StructField(BUCKETS, IntegerType()), StructField(BLOCK, LongType())]
    return StructType([*counts, *words, StructField(LOW, key), StructField(HIGH, key)])


def block_of(keys: Sequence[str], blocks: Column) -> Column:
    return F.xxhash64(*keys).bitwiseAND(blocks - 1)


def _bits(keys: Sequence[str]) -> list[Column]:
    """The bit that a key sets in each word."""
    pattern = F.xxhash64(F.lit("pattern"), *keys)
    return [F.shiftrightunsigned(pattern, 5 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for i in range(WORDS)]


def key_filter(rows: DataFrame, keys: Sequence[str], blocks: int, buckets: int) -> DataFrame:
    """One row per block that holds a key of ``rows``."""
    marked = rows.select(block_of(keys, F.lit(blocks)).alias(BLOCK), F.col(keys[0]).alias(LOW), *[b.alias(w) for b, w in zip(_bits(keys), _WORD, strict=True)])
    words = [F.expr(f"bit_or(shiftleft(1, {w}))").cast("int").alias(w) for w in _WORD]
    found = marked.groupBy(BLOCK).agg(*words, F.max(LOW).alias(HIGH), F.min(LOW).alias(LOW))
    return found.select(F.lit(blocks).cast("long").alias(BLOCKS), F.lit(buckets).cast("int").alias(BUCKETS), BLOCK, *_WORD, LOW, HIGH)


def seeming_known(rows: DataFrame, keys: Sequence[str], filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Keys of ``rows`` with the columns of each filter row that may hold them.

    ``sizes`` are the numbers of blocks that the filters have: a few powers of two.
    """
    probes = rows.select(*keys, F.explode(F.array(*[F.lit(x).cast("long") for x in sizes])).alias(BLOCKS))
    probes = probes.withColumn(BLOCK, block_of(keys, F.col(BLOCKS)))
    set_all = reduce(lambda a, b: a & b, [F.getbit(F.col(w), bit) == 1 for w, bit in zip(_WORD, _bits(keys), strict=True)])
    return probes.join(filters, [BLOCKS, BLOCK]).where(F.col(keys[0]).between(F.col(LOW), F.col(HIGH)) & set_all).drop(*_WORD, LOW, HIGH)
