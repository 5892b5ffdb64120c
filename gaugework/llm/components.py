"""Connected components of a table of links, by repeated stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """node, root for every node that ``links`` (a, b) name; root is the smallest node of its component.

    Large stars and small stars in turn: every node's larger neighbours are linked to its smallest one, then
    its smaller neighbours are. The number of links never grows, the longest path halves, and at the end
    all nodes hang on their root. Each round is written to the shared folder, so that a lost executor
    costs one round. Neighbourhoods are reduced by minimum before the join, so that no task holds one.
    """
    links = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _stars(links):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        links = stored(small.where("a <> b").distinct(), "stars")
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _stars(links: DataFrame) -> bool:
    """Whether every node has one link to a smaller node or only links from larger ones."""
    several = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    between = links.select("a").join(links.select(F.col("b").alias("a")), "a", "left_semi")
    return several.unionByName(between).isEmpty()
