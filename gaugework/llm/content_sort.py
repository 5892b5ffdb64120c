"""Exact duplicates by a content sort: equal texts become neighbours, and neighbours are compared in full.

``repartitionByRange`` samples splitters over the beginning of the normalised text and its hash (so that
the sample on the driver stays small however long the texts are) and deals the rows out by range, the
sort inside each range spills to disk when it must, and the window over the sorted rows starts a new
class wherever a whole text differs from the one before it. Range partitioning already satisfies the
window, so that the text crosses the network once.

A text with more than ``rows_per_piece`` copies is cut into pieces by a hash of its id, so that its
copies spread over many ranges; the pieces' winners are then compared by digest, without their texts.

Defined results: a null text counts as empty; empty texts are copies of each other; null ids come after
all others; of fully repeated rows one stays; an empty table gives an empty result; further columns
are ignored by ``classes`` and carried by ``drop_copies``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import query, stored, table, text_or_empty

#: What normalisation deletes: space, tab, newline, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
ROWS_PER_PIECE = 1000
#: Characters of a text that splitters hold.
HEAD = 64


def _sorted_pieces(docs: DataFrame, payload: list[str], rows_per_piece: int) -> DataFrame:
    """Columns id, cp, pieces, digest, place, size, best and ``payload`` (a struct) for every row.

    place, size and best describe the row's piece; a text that was not cut (pieces null) is one piece.
    """
    text = text_or_empty()
    base = docs.select(
        F.col("doc_id").alias("id"),
        F.regexp_replace(text, BLANKS, "").alias("body"),
        F.struct(*[F.col(f"`{c}`") for c in payload or ["text"]]).alias("payload"),
    )
    # only the text as it is crosses the network; the normalised one is made again on the other side
    base = base.select("id", "payload", F.substring("body", 1, HEAD).alias("head"), F.xxhash64("body").alias("print"))
    counted = docs.select(F.xxhash64(F.regexp_replace(text, BLANKS, "")).alias("print")).groupBy("print").agg(F.count(F.lit(1)).alias("n"))
    large = stored(
        counted.where(F.col("n") > rows_per_piece).select("print", F.ceil(F.col("n") / rows_per_piece).alias("pieces")), "large-texts"
    )
    spread = (
        base.join(large, "print", "left")
        .withColumn("piece", F.when(F.col("pieces").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.col("pieces"))))
        .repartitionByRange("head", "print", "piece")
    )
    text = F.coalesce(F.col("payload.text"), F.lit(""))
    spread = spread.withColumns({"body": F.regexp_replace(text, BLANKS, ""), "cp": F.length(text)})
    run = Window.partitionBy("head", "print", "piece", "body")
    ranked = run.orderBy(F.desc("cp"), F.asc_nulls_last("id"))
    return spread.select(
        "id",
        "cp",
        "pieces",
        F.sha2("body", 256).alias("digest"),
        F.row_number().over(ranked).alias("place"),
        F.count(F.lit(1)).over(run).alias("size"),
        F.first("id").over(ranked).alias("best"),
        *(["payload"] if payload else []),
    )


def classes(docs: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points before normalisation stays, then the smallest id.
    """
    rows = stored(_sorted_pieces(docs, [], rows_per_piece), "content-classes")
    whole = rows.where(F.col("pieces").isNull()).select(
        "id", "best", F.col("size").alias("group_size"), (F.col("place") == 1).alias("kept"), "digest"
    )
    cut = rows.where(F.col("pieces").isNotNull())
    joined = cut.groupBy("digest").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.min(F.struct((-F.col("cp")).alias("cp"), F.col("id").isNull().alias("none"), F.col("id"))).alias("first"),
    )
    parts = cut.select("id", "place", "digest").join(joined, "digest")
    parts = parts.select(
        "id", F.col("first.id").alias("best"), "group_size", ((F.col("place") == 1) & F.col("id").eqNullSafe(F.col("first.id"))).alias("kept"), "digest"
    )
    return whole.unionByName(parts).select(
        F.col("id").alias("doc_id"), F.col("best").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def drop_copies(docs: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    columns = docs.columns
    winners = stored(
        _sorted_pieces(docs, columns, rows_per_piece).where("place = 1").select("id", "cp", "pieces", "digest", "payload"), "content-winners"
    )
    again = Window.partitionBy("digest").orderBy(F.desc("cp"), F.asc_nulls_last("id"))
    whole = winners.where(F.col("pieces").isNull()).select("payload.*")
    cut = winners.where(F.col("pieces").isNotNull()).withColumn("place", F.row_number().over(again)).where("place = 1").select("payload.*")
    return whole.unionByName(cut)


@query(
    "op7_content_sort",
    r"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS original, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
    ), k AS (
        SELECT doc_id, sha256(body) AS text_sha256,
            first_value(doc_id) OVER (PARTITION BY body ORDER BY length(original) DESC, doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
            count(*) OVER (PARTITION BY body) AS group_size
        FROM d
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
    """,
)
def op7_content_sort(spark, folder):
    """Exact copies of whole normalised texts."""
    return classes(table(spark, folder, "documents").select("doc_id", "text"))
