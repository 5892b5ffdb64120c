"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are drawn from the vectors themselves: those with the smallest hashes of their
contents, about ``per_root`` x sqrt(vectors) of them, at most ``most_pivots`` (the bound of what is
broadcast). Of pivots within 1.5 times the threshold's angle of each other only the first stays, so that a dense
group has one pivot, not a share of them among which its members would scatter. Every vector is described by
its ``prefix`` nearest pivots. The inverted list of a pivot holds the vectors that have it in their
description; two vectors are compared when they share their nearest pivot or at least ``shared`` pivots, in
the list of the first pivot that they share, so that each pair is verified once, by cosine in double precision.

A list is cut into blocks of at most ``block`` vectors, and every pair of blocks is one group of work, so
that no task holds a list of any length. A group returns sums and a spanning forest, never pairs: for each
vector the number of links found and the smallest vector of its component within the group. Links are
summed over groups, and the forests are joined by ``components``.

Equal vectors are merged first and counted as many, so that copies form no pairs.

Defined results: vectors that are null, zero, or hold null or non-finite components, link with nothing
and are components of their own; so do vectors whose length no other has; repeated rows are copies that
link with each other; null ids come after all others; an empty table gives an empty result; other columns
are ignored. Cosines of different vectors are compared with the threshold as computed, without tolerance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import query, stored, table
from .components import components

THRESHOLD = 0.95
PREFIX, SHARED = 8, 2
PER_ROOT, MOST_PIVOTS = 4.0, 4096
BLOCK = 1024


def _distinct(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, node) and the distinct usable vectors (node, size, v); node is a digest of the components.

    A node is null where the vector can't link.
    """
    v = F.transform("embedding", lambda x: x.cast("double"))
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    digest = F.unhex(F.sha2(F.concat_ws(",", F.transform(v, lambda x: (x + F.lit(0.0)).cast("string"))), 256))
    rows = vectors.select("vec_id", v.alias("v"), F.when(F.coalesce(usable, F.lit(False)), digest).alias("node"))
    rows = stored(rows, "vectors")
    nodes = rows.where("node is not null").groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.first("v").alias("v"))
    return rows.select("vec_id", "node"), nodes


def _unit(batch: list[list[float]]) -> np.ndarray:
    x = np.array(batch, dtype=np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _apart(units: np.ndarray, threshold: float) -> np.ndarray:
    """The rows that are further than 1.5 times the threshold's angle from all rows kept before them."""
    limit = math.cos(min(math.pi, 1.5 * math.acos(max(-1.0, min(1.0, threshold)))))
    near, gone = units @ units.T >= limit, np.zeros(len(units), dtype=bool)
    for i in range(len(units)):
        if not gone[i]:
            gone[i + 1 :] |= near[i, i + 1 :]
    return units[~gone]


def choose_pivots(nodes: DataFrame, n: int, per_root: float = PER_ROOT, most: int = MOST_PIVOTS, threshold: float = THRESHOLD) -> dict[int, np.ndarray]:
    """Pivots by vector length: a bounded number of vectors with the smallest hashes, none near another."""
    wanted = min(most, max(16, math.ceil(per_root * math.sqrt(n))))
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(wanted).select("v").collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    return {k: _apart(_unit(v), threshold) for k, v in by_size.items()}


def described(nodes: DataFrame, pivots: dict[int, np.ndarray], prefix: int = PREFIX) -> DataFrame:
    """node, size, unit, near for every node: near are its nearest pivots in order, nearest first.

    Vectors of a length that no pivot has get the description [0]: all of one length share a list.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2).to_pylist()
            units, near = [None] * len(vectors), [None] * len(vectors)
            for size in {len(v) for v in vectors}:
                at = [i for i, v in enumerate(vectors) if len(v) == size]
                unit, own = _unit([vectors[i] for i in at]), shared.value.get(size)
                k = min(prefix, len(own)) if own is not None else 1
                order = np.argsort(-(unit @ own.T), axis=1, kind="stable")[:, :k] if own is not None else np.zeros((len(at), 1), dtype=np.int64)
                for j, i in enumerate(at):
                    units[i], near[i] = unit[j], order[j].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(units, pa.list_(pa.float64())), pa.array(near, pa.list_(pa.int32()))],
                names=["node", "size", "unit", "near"],
            )

    return nodes.select("node", "size", "v").mapInArrow(run, "node binary, size bigint, unit array<double>, near array<int>")


def _sets(parts: list[pd.DataFrame], pivot: int) -> tuple[list[np.ndarray], int]:
    """Descriptions as 0/1 rows over the pivots that occur; how many of these come before ``pivot``."""
    seen = np.unique(np.concatenate([x for part in parts for x in part["near"]]))
    out = []
    for part in parts:
        rows = np.zeros((len(part), len(seen)), dtype=np.float32)
        lengths = [len(x) for x in part["near"]]
        rows[np.repeat(np.arange(len(part)), lengths), np.searchsorted(seen, np.concatenate(list(part["near"])))] = 1
        out.append(rows)
    return out, int(np.searchsorted(seen, pivot))


def _compare(left: pd.DataFrame, right: pd.DataFrame, same: bool, pivot: int, threshold: float, shared: int) -> pd.DataFrame:
    """Links between two blocks of one list: node, links, root of the spanning forest."""
    (a, b), first = _sets([left, right], pivot)
    least = min(shared, *(len(x) for x in left["near"]), *(len(x) for x in right["near"]))
    nearest = [np.array([x[0] for x in part["near"]]) for part in (left, right)]
    candidates = (a @ b.T >= least) | (nearest[0][:, None] == nearest[1])
    candidates &= a[:, :first] @ b[:, :first].T == 0  # others belong to an earlier pivot's list
    if same:
        candidates = np.triu(candidates, 1)
    i, j = np.nonzero(candidates & (np.stack(left["unit"]) @ np.stack(right["unit"]).T >= threshold))
    nodes, sizes = left["node"].to_numpy(), left["size"].to_numpy()
    if not same:
        j = j + len(left)
        nodes, sizes = np.concatenate([nodes, right["node"].to_numpy()]), np.concatenate([sizes, right["size"].to_numpy()])
    count, root = np.zeros(len(nodes), dtype=np.int64), np.arange(len(nodes))
    np.add.at(count, i, sizes[j])
    np.add.at(count, j, sizes[i])
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    hit = np.nonzero(count)[0]
    return pd.DataFrame({"node": nodes[hit], "links": count[hit], "root": nodes[root[hit]]})


def found_links(nodes: DataFrame, threshold: float = THRESHOLD, shared: int = SHARED, block: int = BLOCK) -> DataFrame:
    """node, links, root by group of work, from described nodes."""
    lists = nodes.select("node", "size", "unit", "near", F.size("unit").alias("dim"), F.explode("near").alias("pivot"))
    key = ["dim", "pivot"]
    sizes = lists.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = lists.join(sizes, key).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = F.expr("explode(transform(sequence(0, blocks - 1), o -> named_struct('low', least(own, o), 'high', greatest(own, o))))")
    groups = dealt.select(*key, "own", "node", "size", "unit", "near", pairs.alias("pair")).select("*", "pair.*").drop("pair")

    def work(group: pd.DataFrame) -> pd.DataFrame:
        low, high = int(group["low"].iloc[0]), int(group["high"].iloc[0])
        left = group[group["own"] == low]
        right = left if low == high else group[group["own"] == high]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "root": []})
        return _compare(left, right, low == high, int(group["pivot"].iloc[0]), threshold, shared)

    return groups.groupBy(*key, "low", "high").applyInPandas(work, "node binary, links bigint, root binary")


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, prefix: int = PREFIX, shared: int = SHARED, per_root: float = PER_ROOT, most_pivots: int = MOST_PIVOTS
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding)."""
    rows, nodes = _distinct(vectors)
    nodes = stored(nodes, "distinct-vectors")
    known = stored(described(nodes, choose_pivots(nodes, nodes.count(), per_root, most_pivots, threshold), prefix), "described-vectors")
    found = stored(found_links(known, threshold, shared), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_node = nodes.select("node", "size").join(links, "node", "left").join(roots, "node", "left")
    per_node = per_node.select("node", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("root", "node").alias("root"))
    labelled = stored(rows.join(per_node, "node", "left"), "vector-components")
    first = labelled.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("first"))
    return labelled.join(first, "root", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("first")).alias("component_id"),
        (F.col("root").isNull() | F.col("vec_id").eqNullSafe(F.col("first"))).alias("kept"),
    )


@query(
    "op3_pivot_permutation",
    """
    WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    g AS (SELECT vec_id, e, len(e) AS d FROM v
        WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
    r(id, root) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a),
    c AS (SELECT id, min(root) AS root FROM r GROUP BY 1),
    n AS (SELECT a AS id, count(*) AS n FROM l GROUP BY 1)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
    FROM v LEFT JOIN c ON c.id = vec_id LEFT JOIN n ON n.id = vec_id
    """,
)
def op3_pivot_permutation(spark, folder):
    """Links and components of all vectors at cosine 0.95."""
    return near_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding"))

