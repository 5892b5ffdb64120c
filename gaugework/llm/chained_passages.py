"""Repeated passages across documents, exact or fuzzy, by collinear chaining of shared seeds.

Seeds are five-word shingles that are minimal among ``window`` neighbours (minimizers), so that any run of
``window`` + 4 equal words in two texts shares one. Nodes are digests of a text's words. A seed of up to ``PAIRS_TO``
texts links all of them with each other. In one of more texts, every text is linked to the smallest node and to the
nearest smaller one first; where texts share the seed but no passage over it with the smallest one, they are compared with
all others of the seed, in blocks: pairs whose words around the seed are alike, word by word or by a chain of common seeds,
are linked until they hang together, so that no link between different passages is lost. The links of two texts are anchors; chains of anchors that rise
in both texts, with a cost for gaps, are found with a Fenwick tree over the positions in the second text
in O(n log n). Each chain is then aligned word by word between its anchors and extended at both ends. A
passage is reported when it has at least ``min_words`` words and ``similarity`` of them are aligned to
equal words.

Texts are split into words once. Seeds and nodes are made of 64-bit hashes of words; alignments compare 32 bits of them.
Texts with the same words are merged before. A seed in many texts would still make one large group. Such
seeds are found in a sample of the documents (by a hash of the text) and their occurrences are dealt
into parts, whose smallest occurrences are linked in turn. The sample decides only how the work is dealt.

Defined results: null and empty texts and those with fewer than ``min_words`` words have no passages; a
text with the same words as another one is reported whole, as a copy of the document with the smallest id;
passages of such a group are reported for that document only; repeated rows are copies; null ids come after
all others; repetitions within one document aren't reported; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import lookup, query, stored, table
from .words import SHINGLE, shingles, word_hashes

WINDOW, MIN_WORDS, SIMILARITY = 10, 50, 0.8
#: Cost of a word of gap in either text; a seed is worth its five words.
GAP = 0.1
#: Words of a gap, in either text, at which a chain is cut.
LONGEST_GAP = 32
#: One text in so many is looked at for seeds that occur in many texts; how many occurrences form a part. A seed
#: is dealt into parts only from a share of all seeds on, so that at most 1 / COMMON_SHARE of them reach the driver.
SAMPLED, ROWS_PER_PART, COMMON_SHARE = 100, 1000, 1e-6
CHAINS_A_PART = 200
#: Runs of a seed (its occurrences near each other in one text) up to which all pairs are linked at once.
PAIRS_TO = 16
#: Occurrences of a seed that one group of the later comparison takes from either side.
BLOCK = 8192
#: Words around a chain that go with it at first; chains that extend to their end are aligned again with whole texts.
MARGIN = 64
#: Characters of texts that are split into words at once.
CHARACTERS = 50_000
#: Pairs of a group that are counted out word by word at once; of more, only those that share a rare word are.
COUNTED_OUT = 1 << 18


def minimizers(keys: np.ndarray, window: int, sizes: np.ndarray | None = None) -> np.ndarray:
    """Positions of the smallest key (the first of equal ones) of every ``window`` neighbouring keys of a text;
    ``sizes`` says how many of ``keys`` each text has."""
    sizes = np.array([len(keys)]) if sizes is None else sizes
    begin = np.cumsum(sizes) - sizes
    spots = [int(i + np.argmin(keys[i : i + n])) for i, n in zip(begin.tolist(), sizes.tolist(), strict=True) if 0 < n < window]
    if (sizes >= window).any():
        least, at, size = keys, np.arange(len(keys)), 1
        while size < window:  # of two windows next to each other, or that overlap
            step = min(size, window - size)
            later = least[step:] < least[:-step]
            least, at = (np.where(later, x[step:], x[:-step]) for x in (least, at))
            size += step
        room = np.repeat(begin + sizes, sizes)[: len(at)] - np.arange(len(at))
        at = at[room >= window]
        at = at[np.append(True, at[1:] != at[:-1])]
        spots = np.sort(np.append(at, spots)) if spots else at
    return np.asarray(spots, dtype=np.int64)


def _node(words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(words.tobytes(), digest_size=8).digest(), "little", signed=True)


def _seeded(docs: DataFrame, window: int, min_words: int) -> DataFrame:
    """doc_id, node, n, keys, places (eight and four bytes a seed), words (four bytes each) for every row of enough words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            low, held = 0, 0
            for high, text in enumerate(texts, 1):
                held += len(text or "") + 1
                if held >= CHARACTERS or high == len(texts):
                    yield seeded(batch.column(0).slice(low, high - low), texts[low:high])
                    low, held = high, 0

    def seeded(ids: pa.Array, texts: list[str | None]) -> pa.RecordBatch:
        words, sizes = word_hashes(texts)
        pick = np.nonzero(sizes >= max(min_words, 1))[0]
        words, sizes = words[np.repeat(sizes >= max(min_words, 1), sizes)], sizes[pick]
        stop = np.cumsum(sizes)
        start = stop - sizes
        long = sizes >= SHINGLE
        own = shingles(words) if long.any() else words[:0]
        runs = np.where(long, sizes - SHINGLE + 1, 0)
        inner = np.repeat(start, runs) + np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
        own = own[inner]
        spots = minimizers(own, window, runs)
        edges = np.searchsorted(spots, np.append(0, np.cumsum(runs))).tolist()
        first = np.cumsum(runs) - runs
        places = (spots - np.repeat(first, np.diff(edges))).astype(np.int32)
        keys, short = own[spots], (words >> np.uint64(32)).astype(np.uint32) | np.uint32(2)
        key_bytes, place_bytes, nodes = [], [], []
        for i, (low, high) in enumerate(zip(start.tolist(), stop.tolist(), strict=True)):
            nodes.append(_node(words[low:high]))
            if long[i]:
                key_bytes.append(keys[edges[i] : edges[i + 1]].tobytes())
                place_bytes.append(places[edges[i] : edges[i + 1]].tobytes())
            else:  # fewer words than a seed: one seed of all
                key_bytes.append(shingles(words[low:high]).tobytes())
                place_bytes.append(np.zeros(1, dtype=np.int32).tobytes())
        word_bytes = [short[low:high].tobytes() for low, high in zip(start.tolist(), stop.tolist(), strict=True)]
        columns = [ids.take(pa.array(pick, pa.int64())), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32())]
        columns += [pa.array(x, pa.binary()) for x in (key_bytes, place_bytes, word_bytes)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "n", "keys", "places", "words"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, node bigint, n int, keys binary, places binary, words binary")


def seeds(rows: DataFrame, common: dict[int, int] | None = None) -> DataFrame:
    """key, part, node, at: the seeds of every row of ``rows``; ``common`` says into how many parts a key is dealt."""
    shared = rows.sparkSession.sparkContext.broadcast(common or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.array(sorted(shared.value), dtype=np.int64)
        parts = np.array([shared.value[k] for k in many.tolist()], dtype=np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                held = batch.slice(low, 2000)
                places = [np.frombuffer(x, dtype=np.int32) for x in held.column("places").to_pylist()]
                key = np.frombuffer(b"".join(held.column("keys").to_pylist()), dtype=np.int64)
                node = np.repeat(held.column("node").to_numpy(), [len(x) for x in places])
                part = np.zeros(len(key), dtype=np.int32)
                if len(many):
                    at = np.minimum(np.searchsorted(many, key), len(many) - 1)
                    hit = many[at] == key
                    part[hit] = 1 + ((node[hit].view(np.uint64) >> np.uint64(20)) % parts[at[hit]].astype(np.uint64)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, part, node, np.concatenate(places))], names=["key", "part", "node", "at"])

    return rows.select("keys", "places", "node").mapInArrow(run, "key bigint, part int, node bigint, at int")


def _common_seeds(rows: DataFrame, sampled: int, rows_per_part: int) -> dict[int, int]:
    """Seeds of more than about ``rows_per_part`` occurrences and how many parts they get, a power of two so that
    the seeds of one passage are mostly dealt alike."""
    some = rows.where(F.pmod(F.xxhash64("node"), F.lit(sampled)) == 0)
    counts = stored(seeds(some).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "seed-sample")
    least = max(rows_per_part / sampled, COMMON_SHARE * (counts.agg(F.sum("n")).first()[0] or 0))
    return {r["key"]: 1 << (int(r["n"] * sampled / rows_per_part)).bit_length() for r in counts.where(F.col("n") > least).collect()}


def _whole_groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[np.ndarray]]:
    """The columns of sorted batches, dealt anew so that rows equal in the first ``by`` columns come together."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        if held and all(c[-1] == h[-1] for c, h in zip(columns[:by], held[-1][:by], strict=True)):
            held.append(columns)
            continue
        whole = [np.concatenate(x) for x in zip(*held, columns, strict=True)]
        change = np.zeros(len(whole[0]) - 1, dtype=bool)
        for c in whole[:by]:
            change |= c[1:] != c[:-1]
        edges = np.nonzero(change)[0]
        cut = int(edges[-1]) + 1 if len(edges) else 0
        if cut:
            yield [c[:cut] for c in whole]
        held = [[c[cut:] for c in whole]]
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _links_of(key: np.ndarray, part: np.ndarray, node: np.ndarray, at: np.ndarray, pairs_to: int) -> list[np.ndarray]:
    """node, other, p, q, key, kind of whole groups (key, part), sorted by node and at.

    The occurrences of a seed in one text that are near each other form a run; two runs are linked occurrence by
    occurrence. Groups of at most ``pairs_to`` runs: all pairs. Others: to the first run (kind 1)
    and to the last one of the text before (kind 2).
    """
    same = np.zeros(len(key), dtype=bool)
    same[1:] = (key[1:] == key[:-1]) & (part[1:] == part[:-1]) & (node[1:] == node[:-1])
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = ~same[1:] | (at[1:] != at[:-1])
    key, part, node, at, same = (x[fresh] for x in (key, part, node, at, same))
    new_run = ~same
    new_run[1:] |= np.diff(at) > LONGEST_GAP + SHINGLE
    start = np.nonzero(new_run)[0]
    length = np.diff(np.append(start, len(key)))
    key, part, node = key[start], part[start], node[start]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    heads = np.nonzero(first)[0]
    group = np.cumsum(first) - 1
    sizes = np.diff(np.append(heads, len(start)))
    hot = (sizes > pairs_to) | (part[heads] > 0)
    spots, end = np.arange(len(start)), (heads + sizes)[group]
    low, high = [], []
    cold = spots[~hot[group]]
    for step in range(1, pairs_to):
        cold = cold[cold + step < end[cold]]
        if not len(cold):
            break
        low.append(cold)
        high.append(cold + step)
    warm = spots[hot[group]]
    before = warm[warm > heads[group[warm]]]
    own = np.ones(len(start), dtype=bool)  # runs of one node in a group: all are linked to the last run of the node before
    own[1:] = first[1:] | (node[1:] != node[:-1])
    begin = np.maximum.accumulate(np.where(own, spots, 0))
    last = begin[before] - 1
    none = last < heads[group[before]]
    to_first, to_last = heads[group[before]], np.where(none, heads[group[before]], last)
    apart = to_last != to_first
    a = np.concatenate([*low, to_first, to_last[apart]]).astype(np.int64)
    b = np.concatenate([*high, before, before[apart]]).astype(np.int64)
    kind = np.zeros(len(a), dtype=np.int32)
    kind[len(a) - int(apart.sum()) :] = 2
    kind[len(a) - len(before) - int(apart.sum()) : len(a) - int(apart.sum())] = 1
    keep = node[a] != node[b]
    a, b, kind = a[keep], b[keep], kind[keep]
    many = np.minimum(length[a], length[b])
    row = np.repeat(np.arange(len(a)), many)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    return [node[b][row], node[a][row], at[start[b][row] + rank], at[start[a][row] + rank], key[a][row], np.where(rank == 0, kind[row], 0)]


def seed_links(found: DataFrame, pairs_to: int = PAIRS_TO) -> DataFrame:
    """node, other, p, q, key, kind: the seed key at p of node is at q of other; other < node. Where not all texts of a seed
    are linked with each other, kind is 1 for links to the first text, 2 to the one before, 3 between parts; else 0."""
    names = ["node", "other", "p", "q", "key", "kind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_groups(batches, 1):
            again = columns[0][1:] == columns[0][:-1]
            columns = [x[np.append(again, False) | np.append(False, again) | (columns[1] > 0)] for x in columns]
            if not len(columns[0]):
                continue
            order = np.lexsort(columns[::-1])
            columns = [x[order] for x in columns]
            *links, key, kind = _links_of(*columns, pairs_to)
            heads = np.nonzero(columns[1] > 0)[0]
            if len(heads):  # parts of a common seed count from 1: their first occurrences are linked afterwards
                own = np.ones(len(heads), dtype=bool)
                own[1:] = (columns[0][heads[1:]] != columns[0][heads[:-1]]) | (columns[1][heads[1:]] != columns[1][heads[:-1]])
                heads = heads[own]
            arrays = [pa.concat_arrays([pa.array(x), pa.array(y)]) for x, y in zip(links[::2], (columns[2][heads], columns[3][heads]), strict=True)]
            other, q = (pa.concat_arrays([pa.array(x), pa.nulls(len(heads), sort)]) for x, sort in ((links[1], pa.int64()), (links[3], pa.int32())))
            keys, kinds = np.append(key, columns[0][heads]), np.append(kind, np.full(len(heads), 3)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([arrays[0], other, arrays[1], q, pa.array(keys), pa.array(kinds)], names=names)

    ordered = found.repartition("key", "part").sortWithinPartitions("key")
    linked = stored(ordered.mapInArrow(run, "node bigint, other bigint, p int, q int, key bigint, kind int"), "seed-links")
    heads = linked.where("other is null").select("key", F.struct("node", F.col("p").alias("at")).alias("head"))
    low = heads.groupBy("key").agg(F.min("head").alias("low"))
    across = heads.join(low, "key").where("head.node <> low.node")
    across = across.select(F.col("head.node").alias("node"), F.col("low.node").alias("other"), F.col("head.at").alias("p"), F.col("low.at").alias("q"), "key", F.lit(3).alias("kind"))
    return linked.where("other is not null").unionByName(across)


def unsettled(links: DataFrame, repeated: DataFrame) -> DataFrame:
    """key, node, at, root, n of the seeds whose texts were not all linked and don't all share a passage over that seed with
    the first one; those that do have its node as their root, others their own. n is the number of occurrences."""
    hot = links.where("kind > 0")
    over = (F.col("p") >= F.col("start")) & (F.col("p") < F.col("stop")) & (F.col("q") >= F.col("src_start")) & (F.col("q") < F.col("src_stop"))
    settled = stored(hot.where("kind <> 2").join(repeated, ["node", "other"]).where(over).select("key", "kind", "node", F.col("p").alias("at"), "other").distinct(), "settled")
    ends = hot.select("key", "node", F.col("p").alias("at")).unionByName(hot.select("key", F.col("other").alias("node"), F.col("q").alias("at"))).distinct()
    first = settled.where("kind = 1").select("key", "node", "at", F.col("other").alias("head"))
    lowest = settled.where("kind = 3").groupBy("key", F.col("node").alias("head")).agg(F.min("other").alias("low"))
    placed = ends.join(first, ["key", "node", "at"], "left").withColumn("head", F.coalesce("head", "node"))
    placed = placed.join(lowest, ["key", "head"], "left").select("key", "node", "at", F.coalesce("low", "head").alias("root"))
    placed = stored(placed, "seed-roots")
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    return placed.join(sizes.where("low < high").select("key", "n"), "key")


def _stretches(members: DataFrame, texts: DataFrame, reach: int) -> DataFrame:
    """``members`` with the words around their seed (0 outside of the text) and the seeds near it: keys of
    eight bytes, places from the seed's of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outside, span = np.zeros(reach, dtype=np.uint32), np.arange(2 * reach + SHINGLE)
        for batch in batches:
            listed = batch.column("listed")
            sizes, entries = listed.value_lengths().to_numpy(), listed.flatten()
            places_of = entries.field("at").to_numpy()
            words_out, keys_out, near_out = [], [], []
            low = 0
            for size, *row in zip(sizes.tolist(), *(batch.column(x) for x in ("words", "keys", "places")), strict=True):
                words, keys, spots = (np.frombuffer(x.as_buffer(), dtype=d) for x, d in zip(row, (np.uint32, np.int64, np.int32), strict=True))
                at = places_of[low : low + size]
                words = np.concatenate([outside, words, outside])[at[:, None] + span]
                edges = np.searchsorted(spots, np.stack([at - LONGEST_GAP - SHINGLE, at + LONGEST_GAP + SHINGLE + 1]))
                for i, (a, x, y) in enumerate(zip(at.tolist(), *edges.tolist(), strict=True)):
                    words_out.append(words[i].tobytes())
                    keys_out.append(keys[x:y].tobytes())
                    near_out.append((spots[x:y] - a).astype(np.int8).tobytes())
                low += size
            node = pa.array(np.repeat(batch.column("node").to_numpy(), sizes))
            columns = [entries.field("key"), node, *(entries.field(x) for x in ("at", "root", "n"))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.binary()) for x in (words_out, keys_out, near_out))], names=names)

    names = ["key", "node", "at", "root", "n", "words", "keys", "places"]
    grouped = members.groupBy("node").agg(F.collect_list(F.struct("key", "at", "root", "n")).alias("listed"))
    return grouped.join(texts, "node").mapInArrow(run, "key bigint, node bigint, at int, root bigint, n bigint, words binary, keys binary, places binary")


def later_links(members: DataFrame, texts: DataFrame, min_words: int, similarity: float, block: int = BLOCK) -> DataFrame:
    """node, other, p, q, key, kind between texts that share a seed without hanging together over it. Every pair is compared, in
    blocks, until they hang together: ``min_words`` words around the seed are alike enough word by word, or by the alignment
    of a chain if another common seed is near this one at another distance."""
    reach = min_words - SHINGLE
    rows = stored(_stretches(members, texts, reach), "stretches")
    dealt = rows.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("node", "at"), F.col("blocks")).cast("int"))
    pairs = F.expr("explode(transform(sequence(0, blocks - 1), o -> named_struct('low', least(own, o), 'high', greatest(own, o))))")
    both = dealt.withColumn("pair", pairs).select("key", "pair.*", "own", "node", "at", "root", "words", "keys", "places")
    both = both.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "node", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group = None, []
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if r[:3] != at:
                    yield rows_of(_compared(group, reach, min_words, similarity))
                    at, group = r[:3], []
                group.append(r)
        yield rows_of(_compared(group, reach, min_words, similarity))

    def rows_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=["node", "other", "p", "q"])

    return both.mapInArrow(run, "node bigint, other bigint, p int, q int").distinct()


def _compared(group: list[tuple], reach: int, min_words: int, similarity: float) -> list[tuple]:
    """Links within one group of ``later_links``, low block against high block."""
    sides = [[r for r in group if r[3] == r[k]] for k in (1, 2)]
    if not sides[0] or not sides[1]:
        return []
    names: dict[int, int] = {}
    nodes = [np.array([r[4] for r in x]) for x in sides]
    roots = [np.array([names.setdefault(r[6], len(names)) for r in x]) for x in sides]
    words = [np.frombuffer(b"".join(r[7] for r in x), dtype=np.uint32).reshape(len(x), -1) for x in sides]
    words[1] = np.where(words[1] == 0, 1, words[1])  # what is outside of a text equals nothing
    merged = np.arange(len(names))
    least = int(np.ceil(min_words * similarity))
    chosen: list[tuple[int, int]] = []
    usual = np.bincount(np.concatenate(roots)).argmax()

    def compare(i: int, one: int, others: np.ndarray) -> None:
        """Row i of a side with rows of the other one."""
        others = others[(merged[roots[1 - one][others]] != merged[roots[one][i]]) & (nodes[1 - one][others] != nodes[one][i])]
        if not len(others):
            return
        same = words[1 - one][others] == words[one][i]
        some = np.count_nonzero(same, axis=1) >= least
        if not some.any():
            return
        total = np.cumsum(same[some], axis=1, dtype=np.int16)
        total = np.concatenate([np.zeros((len(total), 1), dtype=np.int16), total], axis=1)
        alike = (total[:, min_words:] - total[:, :-min_words]).max(axis=1) >= least
        for j in others[some][alike].tolist():
            a, b = merged[roots[one][i]], merged[roots[1 - one][j]]
            if a != b:
                merged[merged == b] = a
                chosen.append((i, j) if one == 0 else (j, i))

    odd = [np.nonzero(x != usual)[0] for x in roots]
    one_block = sides[0][0][1] == sides[0][0][2]
    alike_rows = _counted_out(words, least) if len(nodes[0]) * len(nodes[1]) <= COUNTED_OUT else _by_rare_words(words, min_words, least, one_block)
    for i in odd[0].tolist():
        others = alike_rows(0, i)
        compare(i, 0, others[others > i] if one_block else others)
    for j in odd[1].tolist():
        others = alike_rows(1, j)
        others = others[roots[0][others] == usual]
        compare(j, 1, others[others < j] if one_block else others)
    for rows, others in _elsewhere(*sides):
        apart = (merged[roots[0][rows]] != merged[roots[1][others]]) & (nodes[0][rows] != nodes[1][others])
        for i, j in zip(rows[apart].tolist(), others[apart].tolist(), strict=True):
            one, two = merged[roots[0][i]], merged[roots[1][j]]
            if one == two or np.count_nonzero((words[0][i][:, None] == words[1][j]).any(axis=1)) < least:
                continue  # no alignment has more equal words
            p, q = _shared(sides[0][i], sides[1][j])
            if any(any(spans(words[0][i], words[1][j], p[x] + reach, q[x] + reach, min_words, similarity)) for x in chains(p, q)):
                merged[merged == two] = one
                chosen.append((i, j))
    out = []
    for i, j in chosen:
        a, b = sides[0][i], sides[1][j]
        a, b = (a, b) if a[4] > b[4] else (b, a)
        p, q = _shared(a, b)
        out += [(a[4], b[4], a[5] + r, b[5] + t) for r, t in zip(p.tolist(), q.tolist(), strict=True)]
    return out


def _shared(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Places, from the common seed, of the seeds near it that both rows have."""
    _, x, y = np.intersect1d(np.frombuffer(a[8], dtype=np.int64), np.frombuffer(b[8], dtype=np.int64), return_indices=True)
    p, q = (np.frombuffer(r[9], dtype=np.int8)[z].astype(int) for r, z in ((a, x), (b, y)))
    return p, q


def _counted_out(words: list[np.ndarray], least: int) -> Callable[[int, int], np.ndarray]:
    """For a side and a row of it: the rows of the other side with ``least`` words that are equal at equal places."""
    counts = np.zeros((len(words[0]), len(words[1])), dtype=np.int16)
    for x, y in zip(words[0].T, words[1].T, strict=True):
        counts += x[:, None] == y
    found = counts >= least
    return lambda side, i: np.nonzero(found[:, i] if side else found[i])[0]


def _by_rare_words(words: list[np.ndarray], min_words: int, least: int, one_block: bool) -> Callable[[int, int], np.ndarray]:
    """For a side and a row of it: the rows of the other side that may have ``least`` equal words within ``min_words``.

    Words at a place are ordered, rare ones first. Of two rows with so many equal words in a window, the first
    ``min_words`` - ``least`` + 1 words of that window, in this order, have one in common; so only rows with an equal
    word among these are returned, and no pair is lost. Words that no other row has come before all.
    """
    n, width = words[0].shape
    both = np.concatenate(words).astype(np.uint64) | (np.arange(width, dtype=np.uint64) << np.uint64(32))
    _, token = np.unique(both, return_inverse=True)
    token = token.reshape(both.shape)
    counts = [np.bincount(x.ravel(), minlength=int(token.max()) + 1) for x in (token[:n], token[n:])]
    shared = counts[0] > 1 if one_block else (counts[0] > 0) & (counts[1] > 0)
    rank = np.zeros(len(shared), dtype=np.int32)
    kept = np.nonzero(shared)[0]
    rank[kept[np.argsort((counts[0] + counts[1])[kept], kind="stable")]] = np.arange(1, len(kept) + 1)
    ranks = rank[token]
    first = np.zeros(ranks.shape, dtype=bool)
    for low in range(0, len(ranks), 256):
        part = ranks[low : low + 256]
        windows = np.lib.stride_tricks.sliding_window_view(part, min_words, axis=1)
        last = np.partition(windows, min_words - least, axis=2)[:, :, min_words - least]
        limit = np.zeros(part.shape, dtype=np.int32)
        for k in range(last.shape[1]):
            np.maximum(limit[:, k : k + min_words], last[:, k : k + 1], out=limit[:, k : k + min_words])
        first[low : low + 256] = (part > 0) & (part <= limit)
    rows, edges = [], []
    for own, chosen in ((ranks[:n], first[:n]), (ranks[n:], first[n:])):
        at = np.nonzero(chosen)
        order = np.argsort(own[at], kind="stable")
        rows.append(at[0][order])
        edges.append(np.searchsorted(own[at][order], np.arange(len(kept) + 2)))

    def found(side: int, i: int) -> np.ndarray:
        there, edge, size = rows[1 - side], edges[1 - side], len(words[1 - side])
        row = i + n * side
        spots = ranks[row][first[row]]
        if (edge[spots + 1] - edge[spots]).sum() >= size:
            return np.arange(size)
        lists = [there[edge[x] : edge[x + 1]] for x in spots.tolist()]
        return np.unique(np.concatenate(lists)) if lists else np.zeros(0, dtype=np.int64)

    return found


def _elsewhere(low: list[tuple], high: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of low and high that have an equal seed near the common one, before both or after both, at another distance."""
    both = [*low, *high]
    row = np.repeat(np.arange(len(both)), [len(r[9]) for r in both])
    key, place = np.frombuffer(b"".join(r[8] for r in both), dtype=np.int64), np.frombuffer(b"".join(r[9] for r in both), dtype=np.int8)
    used = np.nonzero((place != 0) & (key != low[0][0]))[0]
    order = used[np.lexsort((np.abs(place[used]), row[used], place[used] > 0, key[used]))]
    row, key, place = row[order], key[order], place[order]
    fresh = (np.diff(key, prepend=0) != 0) | (np.diff((place > 0).astype(np.int8), prepend=np.int8(0)) != 0)
    fresh[:1] = True
    nearest = fresh | (np.diff(row, prepend=-1) != 0)
    spot, row, place = (np.cumsum(fresh) - 1)[nearest], row[nearest], place[nearest]
    if not len(row):
        return
    begin = np.nonzero(np.diff(spot, prepend=-1))[0]  # a seed that is at the same distance in all rows says nothing
    some = (np.minimum.reduceat(place, begin) != np.maximum.reduceat(place, begin))[spot]
    sides = [np.nonzero(some & (row < len(low)))[0], np.nonzero(some & (row >= len(low)))[0]]
    first, last = (np.searchsorted(spot[sides[1]], spot[sides[0]], x) for x in ("left", "right"))
    ends = np.cumsum(last - first)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + COUNTED_OUT)))
        many = (last - first)[at:stop]
        one = np.repeat(sides[0][at:stop], many)
        two = sides[1][np.repeat(first[at:stop] - np.cumsum(many) + many, many) + np.arange(len(one))]
        pairs = np.unique((row[one] * len(high) + row[two] - len(low))[place[one] != place[two]])
        yield pairs // len(high), pairs % len(high)
        at = stop


def chains(p: np.ndarray, q: np.ndarray, size: int = SHINGLE, gap: float = GAP) -> list[np.ndarray]:
    """Disjoint chains of anchors (indices in order), best first.

    The value of a chain that ends in anchor i is size + max(0, best value of an earlier anchor j with
    p[j] < p[i] and q[j] < q[i], less gap * (p[i] - p[j] + q[i] - q[j])); the maximum over j is a prefix
    maximum of value[j] + gap * (p[j] + q[j]) in a Fenwick tree over q.
    """
    order = np.lexsort((-q, p))  # of equal p the larger q first: none follows another
    if (np.diff(p[order]) > 0).all() and (np.diff(q[order]) > 0).all():
        return _in_line(p[order], q[order], order, size, gap)
    ranks = np.searchsorted(np.unique(q), q) + 1
    top = int(ranks.max())
    tree: list[tuple[float, int]] = [(0.0, -1)] * (top + 1)
    value, back = np.zeros(len(p)), np.full(len(p), -1)
    for i in order.tolist():
        rank, lift = int(ranks[i]), gap * float(p[i] + q[i])
        best, at = (0.0, -1), rank - 1
        while at > 0:
            if tree[at][1] >= 0 and (best[1] < 0 or tree[at][0] > best[0]):
                best = tree[at]
            at -= at & -at
        gain = best[0] - lift
        value[i] = size
        if best[1] >= 0 and gain > 0:
            value[i] += gain
            back[i] = best[1]
        entry, at = (value[i] + lift, i), rank
        while at <= top:
            if tree[at][1] < 0 or entry[0] > tree[at][0]:
                tree[at] = entry
            at += at & -at
    used, out = np.zeros(len(p), dtype=bool), []
    for i in np.argsort(-value, kind="stable").tolist():
        path = []
        while i >= 0 and not used[i]:
            used[i] = True
            path.append(i)
            i = int(back[i])
        if path:
            out.append(np.array(path[::-1]))
    return out


def _in_line(p: np.ndarray, q: np.ndarray, order: np.ndarray, size: int, gap: float) -> list[np.ndarray]:
    """The same chains where every anchor follows the one before: costs add up, so the one before is always best."""
    costs = (gap * (np.diff(p) + np.diff(q))).tolist()
    value, starts, best = [float(size)], [0], float(size)
    for i, cost in enumerate(costs, 1):
        best -= cost
        if best <= 0:
            starts.append(i)
            best = 0.0
        best += size
        value.append(best)
    out = []
    for start, stop in zip(starts, [*starts[1:], len(value)], strict=True):
        while start < stop:  # up to the peak; what follows it is a chain of its own
            peak = start + int(np.argmax(value[start:stop]))
            out.append((value[peak], order[start : peak + 1]))
            start = peak + 1
    return [path for _, path in sorted(out, key=lambda x: -x[0])]


def chained(links: DataFrame) -> DataFrame:
    """node, other, p, q (arrays of anchor positions) of every chain of at least two anchors, cut at long gaps."""
    reach = LONGEST_GAP + SHINGLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_groups(batches, 1):
            order = np.lexsort(columns[::-1])
            node, other, p, q = (x[order] for x in columns)
            # an anchor without another one of its texts within reach is in no chain
            step = (node[1:] == node[:-1]) & (other[1:] == other[:-1])
            again = np.append(False, step & (p[1:] == p[:-1]) & (q[1:] == q[:-1]))
            node, other, p, q = (x[~again] for x in (node, other, p, q))
            near = (node[1:] == node[:-1]) & (other[1:] == other[:-1]) & (np.diff(p) <= reach)
            keep = np.append(near, False) | np.append(False, near)
            node, other, p, q = (x[keep] for x in (node, other, p, q))
            if not len(p):
                continue
            within = np.append(False, (node[1:] == node[:-1]) & (other[1:] == other[:-1]))
            starts = np.nonzero(~within)[0]
            stops = np.append(starts[1:], len(p))
            dp, dq = np.diff(p, prepend=p[0]), np.diff(q, prepend=q[0])
            # steps that cost less than an anchor is worth: all anchors are one chain
            plain = ~within | ((dp > 0) & (dq > 0) & (dp <= reach) & (dq <= reach) & (GAP * (dp + dq) < SHINGLE))
            simple = np.logical_and.reduceat(plain, starts)
            out = []
            for start, stop, easy in zip(starts.tolist(), stops.tolist(), simple.tolist(), strict=True):
                own_p, own_q = p[start:stop], q[start:stop]
                if easy:
                    parts = [slice(None)]
                else:
                    parts = []
                    for path in chains(own_p.astype(np.int64), own_q.astype(np.int64)):
                        steps = np.maximum(np.diff(own_p[path]), np.diff(own_q[path]))
                        parts += np.split(path, np.nonzero(steps > reach)[0] + 1)
                for part in parts:
                    x, y = own_p[part], own_q[part]
                    if len(x) > 1:
                        out.append((node[start], other[start], x, y))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], names=["node", "other", "p", "q"])

    ordered = links.select("node", "other", "p", "q").repartition("node", "other").sortWithinPartitions("node")
    return ordered.mapInArrow(run, "node bigint, other bigint, p array<int>, q array<int>")


def _matches(a: np.ndarray, b: np.ndarray) -> int:
    """Words of a longest common subsequence; a row of the table at a time."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and (a == b).all():
        return len(a)
    row = np.zeros(len(b) + 1, dtype=np.int32)
    for word in a:
        diagonal = row[:-1] + (b == word)
        row[1:] = np.maximum(row[1:], diagonal)
        np.maximum.accumulate(row, out=row)
    return int(row[-1])


def _goes_on(a: np.ndarray, b: np.ndarray, drop: int = 6) -> bool:
    """Whether an extension into all of a, which is shorter than b, hasn't come to its end there."""
    return not len(a) or bool(np.cumsum(np.where(a == b[: len(a)], 1, -1)).min() >= -drop)


def _extend(a: np.ndarray, b: np.ndarray, drop: int = 6) -> int:
    """Words at the beginning of a and b that an ungapped extension takes: best of matches less mismatches."""
    n = min(len(a), len(b))
    if not n:
        return 0
    score = np.cumsum(np.where(a[:n] == b[:n], 1, -1))
    fallen = np.nonzero(np.maximum.accumulate(np.maximum(score, 0)) - score > drop)[0]
    score = score[: fallen[0]] if len(fallen) else score
    best = int(np.argmax(score)) if len(score) else 0
    return best + 1 if len(score) and score[best] > 0 else 0


def align(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, size: int = SHINGLE) -> tuple[int, int, int, int, float]:
    """Span in a, span in b and the share of aligned equal words (of the longer span) of a chain of anchors."""
    ahead = _extend(a[: p[0]][::-1], b[: q[0]][::-1])
    same = int((a[p[0] - ahead : p[0]] == b[q[0] - ahead : q[0]]).sum()) + size
    end_p, end_q = int(p[0]) + size, int(q[0]) + size
    stop = int(p[-1]) + size
    if p[-1] - p[0] == q[-1] - q[0] and (a[end_p:stop] == b[end_q : end_q + stop - end_p]).all():  # equal words from first to last
        same, end_p, end_q = same + stop - end_p, stop, end_q + stop - end_p
        p, q = p[:1], q[:1]
    for x, y in zip(p[1:].tolist(), q[1:].tolist(), strict=True):
        new_p, new_q = x + size, y + size
        if x < end_p or y < end_q:  # seeds overlap: only the words after the last one are new
            step = min(new_p - end_p, new_q - end_q)
            same += max(0, step)
        else:
            same += _matches(a[end_p:x], b[end_q:y]) + size
        end_p, end_q = max(end_p, new_p), max(end_q, new_q)
    behind = _extend(a[end_p:], b[end_q:])
    same += int((a[end_p : end_p + behind] == b[end_q : end_q + behind]).sum())
    start_p, start_q, stop_p, stop_q = int(p[0]) - ahead, int(q[0]) - ahead, end_p + behind, end_q + behind
    return start_p, stop_p, start_q, stop_q, same / max(stop_p - start_p, stop_q - start_q, 1)


def spans(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, min_words: int, similarity: float, found: tuple | None = None) -> Iterator[tuple]:
    """Passages of a chain: the whole chain if it is alike enough, else what its largest gap divides. ``found`` is its alignment."""
    found = align(a, b, p, q) if found is None else found
    if min(found[1] - found[0], found[3] - found[2]) < min_words:
        return
    if found[4] >= similarity:
        yield found
    elif len(p) > 2:
        cut = 1 + int(np.argmax(np.maximum(np.diff(p), np.diff(q))))
        yield from spans(a, b, p[:cut], q[:cut], min_words, similarity)
        yield from spans(a, b, p[cut:], q[cut:], min_words, similarity)


def _with_slices(found: DataFrame, texts: DataFrame, margin: int | None = MARGIN) -> DataFrame:
    """Chains with the words of their node around them: node, other, part, p, q, words, low (where words begin), rest (words after
    them); all words if ``margin`` is None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, lows, rest = [], [], []
            ends, places = _lists(batch.column("p"))
            for i, text in enumerate(batch.column("words")):
                all_words = np.frombuffer(text.as_buffer(), dtype=np.uint32)
                low, high = 0, len(all_words)
                if margin is not None:
                    low, high = max(0, int(places[ends[i]]) - margin), min(high, int(places[ends[i + 1] - 1]) + SHINGLE + margin)
                lows.append(low)
                rest.append(len(all_words) - high)
                words.append(all_words[low:high].tobytes())
            columns = [*(batch.column(x) for x in ("node", "other", "part", "p", "q")), pa.array(words, pa.binary()), pa.array(lows, pa.int32()), pa.array(rest, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "other", "part", "p", "q", "words", "low", "rest"])

    joined = found.join(texts, "node")
    return joined.mapInArrow(run, "node bigint, other bigint, part bigint, p array<int>, q array<int>, words binary, low int, rest int")


def _lists(column: pa.ListArray) -> tuple[list[int], np.ndarray]:
    """Where the lists of a column begin and end in the array of all their numbers; nulls are empty lists."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    return np.append(0, np.cumsum(sizes)).tolist(), column.flatten().to_numpy()


def aligned(found: DataFrame, texts: DataFrame, min_words: int, similarity: float, margin: int | None = MARGIN) -> DataFrame:
    """node, other, start, stop, src_start, src_stop, similarity of every passage; node and other only for chains that may
    extend beyond the words that go with them. The chains of one other are dealt into parts; each part gets that text once."""
    counted = found.groupBy("other").agg(F.ceil(F.count(F.lit(1)) / CHAINS_A_PART).alias("parts"))
    dealt = found.join(counted, "other").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).drop("parts")
    heads = dealt.select("other", "part").distinct().join(texts.select(F.col("node").alias("other"), F.col("words").alias("text")), "other")
    both = _with_slices(dealt, texts, margin).unionByName(heads, allowMissingColumns=True).repartition("other", "part").sortWithinPartitions("other", "part", F.asc_nulls_first("node"), "p")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            out: list[tuple] = []
            (p_ends, p_all), (q_ends, q_all) = _lists(batch.column("p")), _lists(batch.column("q"))
            columns = [batch.column(x).to_pylist() for x in ("node", "other", "low", "rest", "words", "text")]
            for i, (node, other, begin, rest, words, text) in enumerate(zip(*columns, strict=True)):
                if node is None:
                    own = np.frombuffer(text, dtype=np.uint32)
                    continue
                a, p, q = np.frombuffer(words, dtype=np.uint32), p_all[p_ends[i] : p_ends[i + 1]] - begin, q_all[q_ends[i] : q_ends[i + 1]]
                start, stop, src_start, src_stop, _ = whole = align(a, own, p, q)
                if (begin and start < src_start and _goes_on(a[:start][::-1], own[:src_start][::-1])) or (rest and len(a) - stop < len(own) - src_stop and _goes_on(a[stop:], own[src_stop:])):
                    out.append((node, other, None, None, None, None, None))
                    continue
                for start, stop, src_start, src_stop, share in spans(a, own, p, q, min_words, similarity, whole):
                    out.append((node, other, start + begin, stop + begin, src_start, src_stop, share))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=names)

    names = ["node", "other", "start", "stop", "src_start", "src_stop", "similarity"]
    return both.mapInArrow(run, "node bigint, other bigint, start int, stop int, src_start int, src_stop int, similarity double")


def passages(
    docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, window: int = WINDOW, sampled: int = SAMPLED, rows_per_part: int = ROWS_PER_PART, pairs_to: int = PAIRS_TO
) -> DataFrame:
    """doc_id, start, stop, src_doc_id, src_start, src_stop, similarity: words start .. stop - 1 of a document
    repeat words src_start .. src_stop - 1 of another one. Words are lower-cased runs of letters, digits and underscores."""
    rows = stored(_seeded(docs, window, min_words).withColumn("row", F.monotonically_increasing_id()), "passage-seeds")
    nodes = rows.groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("one"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes.select("node", "one.doc_id", "one.row", "copies"), "passage-owners")
    owned = nodes.where("copies > 1").select("node", F.col("doc_id").alias("own_id"), F.col("row").alias("own_row"))
    gone = lookup(stored(rows.select("row", "node").join(owned, "node").where("row <> own_row").select("row"), "passage-copies"))
    single = rows.join(gone, "row", "left_anti").select("node", "keys", "places")

    def texts_of(wanted: DataFrame, *columns: str) -> DataFrame:
        """node and ``columns`` of the nodes ``wanted``."""
        wanted = lookup(stored(wanted.distinct().join(nodes, "node").select("row"), "passage-wanted"))
        return rows.join(wanted, "row", "left_semi").select("node", *columns)

    def repeats(links: DataFrame) -> DataFrame:
        found = stored(chained(links), "chains")
        texts = texts_of(found.select("node").unionByName(found.select(F.col("other").alias("node"))), "words")
        near = stored(aligned(found, texts, min_words, similarity), "passages")
        longer = stored(near.where("start is null").select("node", "other").distinct(), "longer-pairs")
        if longer.isEmpty():
            return near
        again = found.join(lookup(longer), ["node", "other"], "left_semi")
        whole = stored(aligned(again, texts, min_words, similarity, None), "passages")
        return near.join(lookup(longer), ["node", "other"], "left_anti").unionByName(whole)

    links = seed_links(seeds(single, _common_seeds(single, sampled, rows_per_part)), pairs_to)
    repeated = repeats(links)
    members = stored(unsettled(links, repeated), "unsettled")
    if not members.isEmpty():
        later = stored(later_links(members, texts_of(members.select("node"), "words", "keys", "places"), min_words, similarity), "later-links")
        pairs = stored(later.select("node", "other").distinct(), "later-pairs")
        again = links.select("node", "other", "p", "q").join(pairs, ["node", "other"], "left_semi").unionByName(later)
        repeated = repeated.join(pairs, ["node", "other"], "left_anti").unionByName(repeats(again))
    owner, source = nodes.select("node", "doc_id"), nodes.select(F.col("node").alias("other"), F.col("doc_id").alias("src_doc_id"))
    columns = ["doc_id", "start", "stop", "src_doc_id", "src_start", "src_stop", "similarity"]
    fuzzy = repeated.join(owner, "node").join(source, "other").select(*columns)
    copies = rows.select("doc_id", "node", "n").join(owned.select("node", F.col("own_id").alias("src_doc_id")), "node").where(~F.col("doc_id").eqNullSafe(F.col("src_doc_id")))
    whole = copies.select("doc_id", F.lit(0).alias("start"), F.col("n").alias("stop"), "src_doc_id", F.lit(0).alias("src_start"), F.col("n").alias("src_stop"), F.lit(1.0).alias("similarity"))
    return fuzzy.unionByName(whole)


@query("op10_chained_passages")
def op10_chained_passages(spark, folder):
    """Passages of at least 50 words that documents share, exactly or nearly."""
    return passages(table(spark, folder, "documents").select("doc_id", "text"))
