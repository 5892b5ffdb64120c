"""Nearest neighbours by inner product in a forest of random-projection trees.

A tree has random orthogonal directions, one per level, and splits each of its nodes at the median that a sample
has along the level's direction. For a largest inner product, vectors are divided by the largest norm and get one
more component that brings them to length one; queries get a zero there, so that the nearest by distance are those
of the largest product. Every row is in one leaf of each tree.

A query walks all trees with one priority queue: the next branch is the one whose cell is nearest, by the sum of
squared distances to the planes that were crossed on the way, whichever tree it is of. Pairs of a query and a leaf
meet in groups of at most ``block`` rows and as many queries; each group returns the ``k + 1`` best rows of a query by
exact products (one more, since the query itself is among the rows), and the best over all leaves are kept. The
first leaves of a query, as many as the root of their number, are searched before the others: the last of the
``k + 1`` best found there is a floor, and of the other leaves only rows that reach it are returned.

How many leaves a query takes isn't a constant, but measured: ``calibrated`` compares ``probes`` queries with all
rows, block by block, and takes the smallest number of leaves at which the share ``recall`` of their true neighbours
lies in a leaf taken. Clustered vectors need few leaves; uniformly random ones a large share of them at any size,
and get it. Leaves are taken beyond that number while the rows seen in every tree are fewer than asked for.

Bounds: splits come from at most ``sample`` rows, those with the smallest hashes of their contents, so a tree has at
most ``sample / 16`` leaves; beyond some ``sample / 16 * leaf`` rows the leaves grow, cut into blocks, and nothing
is dropped. The driver holds the sample, the probes, their neighbours and the row counts of leaves. Of equal
vectors only the ``k + 1`` smallest ids can be among anyone's ``k`` nearest, so only these are indexed; queries that
are equal are searched once. Hot leaves are blocks of rows times blocks of queries.

Defined results: vectors that are null, zero or hold null or non-finite components take no part; vectors of
different lengths aren't compared, those of a length that the sample lacks share one leaf; rows that repeat an id and
a vector count once; ids that repeat with different vectors are queries of their own, which don't find each other;
a null id is never a query and comes last among ties; a table without queries or candidates gives an empty result;
other columns are ignored. Products are summed in the order of the components. Up to ``leaf`` rows of a length
the search is exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import query, stored, table

NEAREST = 20
TREES, LEAF, SAMPLE = 4, 1024, 32_768
PROBES, RECALL = 256, 0.96
BLOCK = 2048
PAIRS = 65_536  # whose vectors are held side by side at once
SEED = 11


@dataclass
class Forest:
    """Trees over vectors of one length: ``planes`` (trees, depth, length + 1), ``splits`` per tree and level."""

    depth: int
    planes: np.ndarray
    splits: list[list[np.ndarray]]
    scale: float
    middle: float
    taken: int = 0
    rows: np.ndarray | None = None

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def along(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of unit-ball vectors with their further component: (rows, trees, depth)."""
        return np.einsum("rc,tlc->rtl", x, self.planes, optimize=True)

    def stored_coordinates(self, v: np.ndarray) -> np.ndarray:
        x = v / self.scale
        return self.along(np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))[:, None]]))

    def query_coordinates(self, v: np.ndarray) -> np.ndarray:
        x = v / np.abs(v).max(axis=1, keepdims=True)
        x *= self.middle / np.linalg.norm(x, axis=1, keepdims=True)
        return self.along(np.hstack([x, np.zeros((len(x), 1))]))

    def leaf_of(self, at: np.ndarray) -> np.ndarray:
        """Leaf numbers (rows, trees) of coordinates; those of tree t begin with t * leaves."""
        out = np.zeros(at.shape[:2], dtype=np.int64)
        for t, splits in enumerate(self.splits):
            node = np.zeros(len(at), dtype=np.int64)
            for level, cuts in enumerate(splits):
                node = 2 * node + (at[:, t, level] > cuts[node])
            out[:, t] = node + t * self.leaves
        return out

    def walk(self, at: np.ndarray) -> Iterator[int]:
        """Leaves of all trees in the order in which a query with coordinates (trees, depth) takes them."""
        at, depth = at.tolist(), self.depth
        queue = [(0.0, t, 0, 0) for t in range(len(at))]
        while queue:
            far, t, level, node = heapq.heappop(queue)
            own, splits = at[t], self.splits[t]
            while level < depth:
                gap = own[level] - splits[level][node]
                right = gap > 0
                heapq.heappush(queue, (far + gap * gap, t, level + 1, 2 * node + (not right)))
                level, node = level + 1, 2 * node + right
            yield t * self.leaves + node


def fitted(v: np.ndarray, rows: int, largest: float, trees: int = TREES, leaf: int = LEAF, seed: int = SEED) -> Forest:
    """Trees for ``rows`` vectors of which ``v`` is a sample and ``largest`` the greatest norm."""
    depth = max(0, min(math.ceil(math.log2(max(1.0, rows / leaf))), int(math.log2(max(1.0, len(v) / 16)))))
    if not depth:
        trees = 1
    draw, wide = np.random.default_rng(seed), v.shape[1] + 1
    planes = np.zeros((trees, depth, wide))
    for t in range(trees):
        for low in range(0, depth, wide):
            planes[t, low : low + wide] = np.linalg.qr(draw.normal(size=(wide, wide)))[0][: depth - low]
    middle = float(np.sqrt(np.mean((v / largest) ** 2) * v.shape[1]))
    forest = Forest(depth, planes, [], largest, middle or 1.0)
    at = forest.stored_coordinates(v)
    for t in range(trees):
        node, splits = np.zeros(len(v), dtype=np.int64), []
        for level in range(depth):
            order = np.lexsort((at[:, t, level], node))
            ends = np.searchsorted(node[order], np.arange((1 << level) + 1))
            values = at[order, t, level]
            splits.append(np.array([values[(a + b) // 2] if b > a else 0.0 for a, b in zip(ends[:-1], ends[1:], strict=True)]))
            node = 2 * node + (at[:, t, level] > splits[level][node])
        forest.splits.append(splits)
    return forest


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two arrays, each summed from the first component to the last."""
    return np.cumsum(a * b, axis=1)[:, -1]


def best(
    q: np.ndarray, v: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int, floor: np.ndarray | float = -math.inf
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row of ``q`` the k rows of ``v`` with the largest products, ties to smaller ids: (q row, v row, score).

    Rows below the ``floor`` of their query may be left out.
    """
    rough = q @ v.T
    least = np.full(len(q), floor)
    if v.shape[0] > k:
        least = np.maximum(least, np.partition(rough, -k, axis=1)[:, -k])
    slack = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()  # matrix products round otherwise
    i, j = np.nonzero(~(rough < (least - slack)[:, None]))
    score = np.concatenate([products(q[i[x : x + PAIRS]], v[j[x : x + PAIRS]]) for x in range(0, max(1, len(i)), PAIRS)])
    order = np.lexsort((ids[j], missing[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    start = np.searchsorted(i, np.arange(len(q)))
    keep = np.arange(len(i)) - start[i] < k
    return i[keep], j[keep], score[keep]


def _usable(v: Column) -> Column:
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def _rows(vectors: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows to be found (node, vec_id, v, size) and queries' rows (node, vec_id, v); a node is a digest of the components."""
    digest = F.unhex(F.sha2(F.concat_ws(",", F.transform("embedding", lambda x: (x.cast("double") + F.lit(0.0)).cast("string"))), 256))
    rows = vectors.where(F.coalesce(_usable(F.col("embedding")), F.lit(False)))
    rows = rows.select(digest.alias("node"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    rows = stored(rows.groupBy("node", "vec_id").agg(F.first("v").alias("v")), "search-rows")
    first = Window.partitionBy("node").orderBy(F.col("vec_id").asc_nulls_last())
    found = rows.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1).drop("place")
    return stored(found.withColumn("size", F.size("v")), "search-index"), rows


def _arrays(batch: pa.RecordBatch, name: str = "v") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors of a batch by length: (length, row numbers, values as doubles)."""
    column = batch.column(batch.schema.get_field_index(name))
    sizes = np.diff(column.offsets.to_numpy())
    flat, low = column.values.to_numpy(zero_copy_only=False), column.offsets[0].as_py()
    starts = column.offsets.to_numpy()[:-1] - low
    flat = flat[low:] if low else flat
    for size in np.unique(sizes):
        at = np.nonzero(sizes == size)[0]
        yield int(size), at, flat[starts[at][:, None] + np.arange(size)].astype(np.float64)


def fit(index: DataFrame, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE) -> dict[int, Forest]:
    """A forest for every length of vectors in the sample."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    chosen = index.orderBy(F.xxhash64("node", "vec_id"), "node", "vec_id").limit(sample).select("size", "v")
    got = chosen.toArrow()
    by_size: dict[int, list[np.ndarray]] = {}
    for batch in got.to_batches():
        for size, _, v in _arrays(batch):
            by_size.setdefault(size, []).append(v)
    lengths = index.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest"))
    known = lengths.where(F.col("size").isin(list(by_size))).collect()  # at most as many as rows in the sample
    return {r["size"]: fitted(np.concatenate(by_size[r["size"]]), r["n"], r["largest"], trees, leaf) for r in known}


def dealt(index: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """size, leaf, node, vec_id, v for every row and tree; a length without a forest has the leaf 0 alone."""
    shared = index.sparkSession.sparkContext.broadcast(forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves: list[list[int]] = [[0]] * batch.num_rows
            for size, at, v in _arrays(batch):
                if (forest := shared.value.get(size)) is not None:
                    for i, own in zip(at.tolist(), forest.leaf_of(forest.stored_coordinates(v)).tolist(), strict=True):
                        leaves[i] = own
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int64()))], names=[*batch.schema.names, "leaves"])

    kind = index.schema["v"].dataType.simpleString()
    ddl = f"node binary, vec_id bigint, v {kind}, size int, leaves array<bigint>"
    return index.select("node", "vec_id", "v", "size").mapInArrow(run, ddl)


def calibrated(rows: DataFrame, queries: DataFrame, forests: dict[int, Forest], k: int, probes: int = PROBES, recall: float = RECALL) -> dict[int, Forest]:
    """The forests with ``rows`` per leaf and ``taken``, the leaves that find the share ``recall`` of the probes' neighbours.

    ``rows`` are dealt rows; probes are the queries with the smallest hashes.
    """
    filled = rows.where(F.col("size").isin(list(forests))).select("size", F.explode("leaves").alias("leaf"))
    for size, leaf, n in filled.groupBy("size", "leaf").count().collect():
        forest = forests[size]
        if forest.rows is None:
            forest.rows = np.zeros(len(forest.planes) * forest.leaves, dtype=np.int64)
        forest.rows[leaf] = n
    chosen = queries.orderBy(F.xxhash64("node"), "node").limit(probes).select("v").toArrow()
    by_size: dict[int, list[np.ndarray]] = {}
    for batch in chosen.to_batches():
        for size, _, v in _arrays(batch):
            if size in forests:
                by_size.setdefault(size, []).append(v)
    known = {size: np.concatenate(v) for size, v in by_size.items()}
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = batch.column(batch.schema.get_field_index("leaves"))
            for size, at, v in _arrays(batch):
                if (q := shared.value.get(size)) is not None:
                    i, j, score = best(q, v, at, np.zeros(len(at)), k + 1)
                    columns = [pa.array(np.full(len(i), size), pa.int32()), pa.array(i, pa.int32()), pa.array(score), leaves.take(pa.array(at[j]))]
                    yield pa.RecordBatch.from_arrays(columns, names=["size", "probe", "score", "leaves"])

    near = rows.select("v", "leaves").mapInArrow(compare, "size int, probe int, score double, leaves array<bigint>")
    nearest = Window.partitionBy("size", "probe").orderBy(F.desc("score"))
    near = near.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1)
    wanted: dict[tuple[int, int], list[list[int]]] = {}
    for size, probe, leaves in near.select("size", "probe", "leaves").collect():
        wanted.setdefault((size, probe), []).append(leaves)
    needed: dict[int, list[int]] = {}
    for size, q in known.items():
        forest = forests[size]
        for probe, at in enumerate(forest.query_coordinates(q)):
            open_rows = wanted.get((size, probe), [])
            for number, leaf in enumerate(forest.walk(at), 1):
                left = [x for x in open_rows if leaf not in x]
                needed.setdefault(size, []).extend([number] * (len(open_rows) - len(left)))
                if not (open_rows := left):
                    break
    for size, forest in forests.items():
        order = sorted(needed.get(size, []))
        forest.taken = order[math.ceil(recall * len(order)) - 1] if order else len(forest.planes) * forest.leaves
    return forests


def routed(queries: DataFrame, forests: dict[int, Forest], k: int) -> DataFrame:
    """size, node, v for every query and the leaves that it takes, in their order."""
    shared = queries.sparkSession.sparkContext.broadcast(forests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves: list[list[int]] = [[0]] * batch.num_rows
            for size, at, v in _arrays(batch):
                if (forest := shared.value.get(size)) is None:
                    continue
                trees = len(forest.planes)
                for i, own in zip(at.tolist(), forest.query_coordinates(v), strict=True):
                    seen, some = [0] * trees, []
                    for leaf in forest.walk(own):
                        some.append(leaf)
                        seen[leaf // forest.leaves] += int(forest.rows[leaf])
                        if len(some) >= forest.taken and max(seen) > k:
                            break
                    leaves[i] = some
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int64()))], names=[*batch.schema.names, "leaves"])

    kind = queries.schema["v"].dataType.simpleString()
    return queries.select("node", "v", "size").mapInArrow(run, f"node binary, v {kind}, size int, leaves array<bigint>")


def searched(rows: DataFrame, queries: DataFrame, k: int, block: int = BLOCK) -> DataFrame:
    """query (node), vec_id, score: of every group the k + 1 best rows of each query (size, leaf, node, v, floor).

    What lies below a query's floor is left out.
    """
    key = ["size", "leaf"]
    leaves = rows.select("size", F.explode("leaves").alias("leaf"), "node", "vec_id", "v")
    parts = leaves.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("row_parts"))
    asked = queries.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("query_parts"))
    parts = stored(parts.join(asked, key), "search-parts")
    own = F.pmod(F.xxhash64("node", "vec_id"), F.col("row_parts")).cast("int")
    left = leaves.join(parts, key).select(*key, own.alias("row_part"), F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"), "vec_id", "v")
    own = F.pmod(F.xxhash64("node"), F.col("query_parts")).cast("int")
    right = queries.join(parts, key).select(*key, F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1)).alias("row_part"), own.alias("query_part"), "node", "v", "floor")
    key += ["row_part", "query_part"]

    def work(some: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(asked):
            return pd.DataFrame({"node": [], "vec_id": [], "score": []})
        missing = some["vec_id"].isna().to_numpy()
        ids = some["vec_id"].fillna(0).to_numpy(dtype=np.int64)
        q, v = (np.stack(x["v"].to_list()).astype(np.float64) for x in (asked, some))
        i, j, score = best(q, v, ids, missing, k + 1, asked["floor"].fillna(-math.inf).to_numpy(dtype=np.float64))
        found = pd.Series(ids[j], dtype="Int64").mask(missing[j])
        return pd.DataFrame({"node": asked["node"].to_numpy()[i], "vec_id": found, "score": score})

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(work, "node binary, vec_id bigint, score double")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 best rows of each query with their ``place`` from 1."""
    found = found.groupBy("node", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("node").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)


def nearest(
    vectors: DataFrame, every: int = 20, k: int = NEAREST, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, recall: float = RECALL, block: int = BLOCK
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row whose vec_id is divisible by ``every``."""
    index, rows = _rows(vectors, k)
    asked = rows.where(F.col("vec_id") % every == 0)
    queries = stored(asked.groupBy("node").agg(F.first("v").alias("v")).withColumn("size", F.size("v")), "search-queries")
    forests = fit(index, trees, leaf, sample)
    placed = stored(dealt(index, forests), "search-leaves")
    forests = calibrated(placed, queries, forests, k, recall=recall)
    routes = stored(routed(queries, forests, k), "search-routes")
    few = F.ceil(F.sqrt(F.size("leaves"))).cast("int")
    first = routes.select("size", "node", "v", F.explode(F.slice("leaves", F.lit(1), few)).alias("leaf"), F.lit(None).cast("double").alias("floor"))
    found = stored(ranked(searched(placed, first, k, block), k), "search-first")
    floor = found.where(F.col("place") == k + 1).select("node", F.col("score").alias("floor"))
    rest = routes.join(floor, "node", "left").select("size", "node", "v", F.explode(F.slice("leaves", few + 1, F.size("leaves"))).alias("leaf"), "floor")
    found = ranked(found.drop("place").unionByName(searched(placed, rest, k, block)), k)
    lists = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near"))
    own = asked.select(F.col("vec_id").alias("query_id"), "node").join(lists, "node")
    others = F.slice(F.filter("near", lambda x: ~x["vec_id"].eqNullSafe(F.col("query_id"))), 1, k)
    out = own.select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


@query(
    "op12_projection_forest",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    g AS (SELECT vec_id, e, len(e) AS d FROM v
        WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    p AS (SELECT a.vec_id AS query_id, b.vec_id AS vec_id, list_inner_product(a.e, b.e) AS score
        FROM g a JOIN g b ON a.d = b.d AND a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
)
def op12_projection_forest(spark, folder):
    """The 20 nearest rows by inner product of every row whose id is divisible by 20.

    The SQL is the exact search: it is what the forest returns as long as a length has at most ``LEAF`` rows.
    """
    return nearest(table(spark, folder, "embeddings").select("vec_id", "embedding"))
