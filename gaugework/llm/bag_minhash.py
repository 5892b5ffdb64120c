"""Near duplicates of texts: BagMinHash signatures of word-shingle multisets, banding, exact verification.

Signature: every shingle owns one Poisson process for each weight interval [0, 1), [1, 2), [2, 4), [4, 8),
... of rate ``registers`` times the interval's width. A point has a time, a place in the interval and a
register; it counts for a text when its place lies below the shingle's count there. A register keeps the
time of its first point. Two texts agree in a register with probability sum(min) / sum(max) of their
counts. Points are drawn in order of time up to a bound at which a text of that weight has filled all
registers (the bound doubles for a text that hasn't), so that large texts need about one draw a shingle.

Banding: texts that agree in all ``rows`` registers of one of ``bands`` bands are candidates; at a
similarity of 0.8 the chance to miss a pair is (1 - 0.8 ** rows) ** bands = 3e-4 with 20 bands of 5.

Candidates are verified with their full multisets. Exact copies are first merged by digest. Groups of
candidates are not expanded into all pairs: in each of ``stars`` rounds every member of a bucket that
isn't yet linked to the bucket's largest component is compared with one leader of it. In the buckets that
still hold several components, members of different components are then compared within tasks, in blocks
of ``BLOCK`` members and pairs of blocks, until they are joined; a task returns a spanning forest. So no
link between components is lost, and pairs within one component, which can't change the result, cost nothing.

Defined results: a null text, an empty one and one without words have no shingles and stand alone, each
row for itself; a text of fewer than ``shingle`` words is one shingle; repeated rows are copies; a null id
is kept only in a class without other ids; an empty table gives an empty result; other columns are ignored
by ``near_classes`` and carried by ``drop_near_copies``.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import lookup, query, stored, table
from .components import components
from .memory import only
from .words import HASHES, SHINGLE, bag, mix, shingles

BANDS, ROWS = 20, 5
THRESHOLD = 0.8
STARS = 2
#: Members of a bucket that one group of the last comparison takes from either side.
BLOCK = 256
#: Pairs of one text that one part of the verification holds.
PAIRS_A_PART = 200
_LEVEL = np.uint64(0x9FB21C651E98DF25)
_MASK = (1 << 64) - 1
_STEP = np.uint64(0x9E3779B97F4A7C15)


def signature(keys: np.ndarray, counts: np.ndarray, registers: int) -> np.ndarray:
    """First times of all registers for a multiset of 64-bit keys with whole counts."""
    total = float(counts.sum())
    bound = (math.log(registers) + 3) / total
    top = int(counts.max()).bit_length()  # the interval that holds the largest count
    lows = [0, *(1 << k for k in range(top))]
    parts = [(keys, counts, 0, 1)] + [(keys[counts > low], counts[counts > low], low, low) for low in lows[1:]]
    while True:
        first = np.full(registers, np.inf)
        for level, (own, weight, low, width) in enumerate(parts):
            if len(own):
                _draw(first, mix(own ^ np.uint64((level + 1) * int(_LEVEL) & _MASK)), weight, low, width, registers, bound)
        if np.isfinite(first).all():
            return first
        bound *= 2


def _draw(first: np.ndarray, seeds: np.ndarray, weight: np.ndarray, low: int, width: int, registers: int, bound: float) -> None:
    """Take all points before ``bound`` of the processes with these seeds into ``first``.

    Gaps are whole multiples of 2 ** -40 of the mean, so that sums are exact and a point has the same time in
    every text, however many points are drawn at once.
    """
    times, at, last = np.zeros(len(seeds)), 0, bound * registers * width * 2.0**40
    many = max(1, round(bound * registers * width))  # about as many as a process has before the bound
    while len(seeds):
        draws = np.arange(at + 1, at + many + 1, dtype=np.uint64) * _STEP
        noise = mix(seeds[:, None] + draws[None, :])
        gaps = np.rint(-np.log(((noise >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * 2.0**40)
        points = times[:, None] + np.cumsum(gaps, axis=1)
        row, col = np.nonzero(points < last)
        if len(row):
            more = mix(noise[row, col] ^ _LEVEL)
            place = low + (more >> np.uint64(32)).astype(np.float64) * (width * 2.0**-32)
            # a whole count covers its cells whole: a place counts when its cell lies below the count
            inside = np.floor(place) < weight[row]
            register = ((more & np.uint64(0xFFFFFFFF)) * np.uint64(registers)) >> np.uint64(32)
            np.minimum.at(first, register[inside].astype(np.int64), points[row, col][inside] / width)
        times = points[:, -1]
        going = times < last
        seeds, weight, times, at = seeds[going], weight[going], times[going], at + many
        many = max(many, 3, 512 // max(1, len(seeds)))


def band_keys(first: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key a band."""
    bits = first.view(np.uint64).reshape(bands, rows)
    keys = mix(np.arange(1, bands + 1, dtype=np.uint64) * _LEVEL)
    for k in range(rows):
        keys = mix(keys ^ bits[:, k])
    return keys.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """sum(min) / sum(max) of two multisets given as sorted keys and counts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    union = int(a[1].sum() + b[1].sum()) - both
    return both / union if union else 0.0


def signed(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, print, node, bands for every row; node is a digest of the text's words, null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("words")
        for batch in batches:
            nodes, keys, known = [], [], {}
            for text in batch.column(1):
                words = HASHES.text(text.as_py())
                if not len(words):
                    nodes.append(None)
                    keys.append(None)
                    continue
                node = hashlib.blake2b(words.tobytes(), digest_size=16).digest()
                if node not in known:
                    own, counts = np.unique(shingles(words, shingle), return_counts=True)
                    known[node] = band_keys(signature(own, counts, bands * rows), bands, rows)
                nodes.append(node)
                keys.append(known[node])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "print", "node", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "print").mapInArrow(run, f"doc_id {kind}, print bigint, node binary, bands array<bigint>")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float, shingle: int = SHINGLE) -> DataFrame:
    """a, b, linked for ``pairs`` (a, b) of nodes, with the full multisets of ``texts`` (node, text).

    The pairs of one a are dealt into parts of about ``PAIRS_A_PART``; a part streams by as a's text, then
    the others' texts one by one.
    """
    counted = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_PART).alias("parts"))
    dealt = pairs.join(counted, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    heads = dealt.select("a", F.lit(None).cast("binary").alias("b"), "part").distinct()
    rows = stored(heads.unionByName(dealt).withColumn("node", F.coalesce("b", "a")), "pairs-to-verify")
    rows = texts.join(lookup(rows), "node").drop("node")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            first, second, linked = [], [], []
            for a, b, text in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("text"), strict=True):
                found = bag(text.as_py(), shingle)
                if b is None:
                    own = found
                else:
                    first.append(a)
                    second.append(b)
                    linked.append(overlap(own, found) >= threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return ordered.select("a", "b", "text").mapInArrow(compare, "a binary, b binary, linked boolean")


def _placed(buckets: DataFrame, found: DataFrame | None) -> DataFrame:
    """``buckets`` with each node's root so far."""
    if found is None:
        return buckets.withColumn("root", F.col("node"))
    return buckets.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _unsettled(placed: DataFrame, turn: int) -> DataFrame:
    """Members of the buckets with several roots, with the largest component (top), a leader of it and the bucket's size."""
    sizes = placed.groupBy("key", "root").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("leader"))).alias("first"),
    )
    largest = sizes.groupBy("key").agg(F.max(F.struct("n", "root", "first.leader")).alias("top"), F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"))
    several = largest.where("roots > 1").select("key", F.col("top.root").alias("top"), F.col("top.leader").alias("leader"), "n")
    return stored(placed.join(several, "key"), "unsettled")


def joined_in_buckets(members: DataFrame, texts: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """a, b: links that join components within buckets; ``members`` has key, node, root and n, the bucket's size."""
    dealt = members.select("key", "node", "root", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = F.expr("explode(transform(sequence(0, blocks - 1), o -> named_struct('low', least(own, o), 'high', greatest(own, o))))")
    groups = stored(dealt.select("key", "own", "node", "root", pairs.alias("pair")).select("key", "pair.*", "own", "node", "root"), "bucket-blocks")
    rows = texts.join(lookup(groups), "node").repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "own", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for batch in batches:
            found: list[tuple] = []
            for r in batch.to_pylist():
                key = r["key"], r["low"], r["high"]
                if key != at:
                    found += _join_group(group, threshold)
                    at, group = key, []
                group.append((r["own"] == r["low"], r["own"] == r["high"], r["node"], r["root"], bag(r["text"])))
            yield links(found)
        yield links(_join_group(group, threshold))

    def links(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return rows.select("key", "low", "high", "own", "node", "root", "text").mapInArrow(run, "a binary, b binary")


def _join_group(group: list[tuple], threshold: float) -> list[tuple]:
    """Compare members of different components of one group, low block against high block, until they are joined."""
    parent = {root: root for _, _, _, root, _ in group}

    def find(x: bytes) -> bytes:
        while parent[x] != x:
            x = parent[x]
        return x

    out = []
    for i, (low, _, node, root, own) in enumerate(group):
        if not low:
            continue
        for j, (also_low, high, other, other_root, others) in enumerate(group):
            if not high or (also_low and j <= i):
                continue
            a, b = find(root), find(other_root)
            if a != b and overlap(own, others) >= threshold:
                parent[a] = b
                out.append((node, other))
    return out


def near_components(nodes: DataFrame, docs: DataFrame, threshold: float = THRESHOLD, stars: int = STARS, block: int = BLOCK) -> DataFrame | None:
    """node, root for all nodes that are linked with others, None if no two texts share a band.

    ``nodes`` has node, bands and the doc_id and print of one of its texts, ``docs`` doc_id, text and print.
    """
    spread = nodes.select("node", F.explode("bands").alias("key"))
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    buckets = stored(spread.join(shared, "key"), "buckets")
    if buckets.isEmpty():
        return None
    wanted = lookup(stored(nodes.select("node", "doc_id", "print").join(buckets.select("node").distinct(), "node"), "bucket-nodes"))
    same = docs["doc_id"].eqNullSafe(wanted["doc_id"]) & (docs["print"] == wanted["print"])
    texts = stored(docs.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "node-texts")
    found = tested = links = None
    for turn in range(stars + 1):
        members = _unsettled(_placed(buckets, found), turn)
        if turn < stars:
            pairs = members.where("root <> top").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
            if tested is not None:
                pairs = pairs.join(tested, ["a", "b"], "left_anti")
            seen = stored(verified(stored(pairs, "candidates"), texts, threshold), "verified")
            both = seen.select("a", "b").unionByName(seen.select(F.col("b").alias("a"), F.col("a").alias("b")))
            tested = both if tested is None else tested.unionByName(both)
            fresh = seen.where("linked").select("a", "b")
        else:
            fresh = stored(joined_in_buckets(members, texts, threshold, block), "joined")
        links = fresh if links is None else links.unionByName(fresh)
        found = components(links)
        buckets = members.select("node", "key")
        if buckets.isEmpty():
            break
    return found


def _labelled(docs: DataFrame, threshold: float) -> DataFrame:
    """doc_id, print, node, root for every row; print is a hash of the text."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    rows = stored(signed(docs), "signed")
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(F.struct("doc_id", "print", "bands")).alias("one"))
    found = near_components(stored(nodes.select("node", "one.*"), "nodes"), docs, threshold)
    if found is None:
        return rows.select("doc_id", "print", "node", F.col("node").alias("root"))
    joined = rows.select("doc_id", "print", "node").join(found, "node", "left")
    return stored(joined.withColumn("root", F.coalesce("root", "node")), "labelled")


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    labelled = _labelled(docs, threshold)
    size = labelled.where(F.col("root").isNotNull()).groupBy("root")
    size = size.agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size")).where("class_size > 1")
    one = F.col("class_size").isNull()
    return labelled.join(size, "root", "left").select(
        "doc_id",
        F.when(one, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(one, F.lit(1)).otherwise(F.col("class_size")).cast("bigint").alias("class_size"),
        (one | F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
        "print",
    )


def near_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, class_size, kept for every row of ``docs``; class_id is the smallest id of the class."""
    return _classes(docs, threshold).drop("print")


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their class, with all their columns.

    Rows that repeat one id and text share its decision.
    """
    gone = lookup(stored(_classes(docs, threshold).where("not kept").select("doc_id", "print").distinct(), "near-copies"))
    same = docs["doc_id"].eqNullSafe(gone["doc_id"]) & (F.xxhash64(docs["text"]) == gone["print"])
    return docs.join(gone, same, "left_anti")


@query(
    "op6_bag_minhash",
    r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
    s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
    c AS (SELECT doc_id, g, count(*) AS n FROM s GROUP BY 1, 2),
    t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS m FROM c a JOIN c b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE m / (x.total + y.total - m) >= 0.8),
    r(id, root) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, r.root FROM r JOIN l ON r.id = l.a),
    k AS (SELECT doc_id, coalesce(min(root), doc_id) AS class_id FROM documents LEFT JOIN r ON id = doc_id GROUP BY doc_id)
    SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size, doc_id = class_id AS kept FROM k
    """,
)
def op6_bag_minhash(spark, folder):
    """Near-duplicate classes of all documents."""
    return near_classes(table(spark, folder, "documents").select("doc_id", "text"))

