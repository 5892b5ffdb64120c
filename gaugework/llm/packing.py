"""Best-fit packing of token pieces into sequences by exact-complement hashing.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. There the plan is
made for whole counts at once: for each length, from the longest down, an index of single lengths, sums
of two and sums of three lengths names combinations that fill the gap exactly, and each is consumed as
often as all its lengths are available. What has no exact complement is placed by best fit: into the
open sequences with the smallest gap that holds it. Every step uses up a length or an open kind of
sequence, so that the plan has few entries whatever the number of pieces.

The plan gives each length ranges of ranks; a piece finds its sequence from its rank among the pieces of
its length. Ranks are counted in parts of at most ``rows_per_part`` rows of a length (parts are hashes of
the piece, so a common length spreads over tasks) plus the sizes of the parts before.

Defined results: a null text counts as empty, whose one token is the end token; null ids and fully
repeated rows are packed like any others; an empty table gives an empty result; only doc_id and text
are read.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import query, stored, table, text_or_empty
from .memory import only, remembered
from .pieces import PieceEncoder

CAPACITY = 1024
ROWS_PER_PART = 1_000
#: Pieces that a worker remembers, some 200 MB.
REMEMBERED = 800_000
_ENCODERS: dict[bytes, TextEncoder] = {}
remembered("pieces", lambda: len(_ENCODERS), lambda: _ENCODERS.clear())


class TextEncoder:
    """Ids of whole texts by a tokenizer. Texts that hold the string of an added token are given to it whole."""

    def __init__(self, description: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(description)
        self.added = [x["content"] for x in json.loads(description).get("added_tokens", [])]
        self.sizes = np.zeros(self.tokenizer.get_vocab_size(), dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.sizes[i] = len(token)  # one character of a byte-level token stands for one byte
        self.pieces = PieceEncoder(lambda piece: self.whole(piece).tobytes(), self.many, REMEMBERED, self.apart)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def apart(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def many(self, pieces: list[str]) -> list[bytes]:
        """Pieces are tokenized apart wherever they stand, so that one call does for all."""
        found = self.whole("".join(pieces))
        ends = np.searchsorted(np.cumsum(self.sizes[found]), np.cumsum([len(p.encode()) for p in pieces])) + 1
        raw = found.tobytes()
        return [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]

    def batch(self, texts: list[str]) -> Iterator[bytes]:
        odd = {i for i, text in enumerate(texts) if any(x in text for x in self.added)}
        found = self.pieces.batch("" if i in odd else text for i, text in enumerate(texts))
        for i, ids in enumerate(found):
            yield self.whole(texts[i]).tobytes() if i in odd else ids


def _encoder(description: bytes) -> TextEncoder:
    """One tokenizer per Python worker and vocabulary."""
    key = hashlib.sha256(description).digest()
    if key not in _ENCODERS:
        _ENCODERS[key] = TextEncoder(description.decode())
    return _ENCODERS[key]


def token_pieces(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece of every row of ``docs``.

    A document longer than ``capacity`` is cut from its end into full pieces; its first piece may be shorter.
    """
    with open(tokenizer_file, "rb") as f:
        description = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("pieces")
        encoder = _encoder(description.value)
        for batch in batches:
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, found in enumerate(encoder.batch(batch.column(1).to_pylist())):
                found += end
                n = len(found) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    part = found[4 * a : 4 * b]
                    rows.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(part))
                    if ids:
                        kept.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)] + ([pa.array(kept, pa.list_(pa.int32()))] if ids else [])
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")
    names = [x.split()[0] for x in ddl.split(", ")]
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, ddl)


class _Sums:
    """Which two available lengths have a given sum; three are one length and two more."""

    def __init__(self, counts: list[int]):
        self.counts = counts
        present = [x for x, n in enumerate(counts) if n]
        self.pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, a in enumerate(present):
            for b in present[i:]:
                if a + b >= len(counts):
                    break
                self.pairs[a + b].append((b, a))
        self.present = present[::-1]

    def _available(self, kind: tuple[int, ...]) -> bool:
        return all(self.counts[x] >= kind.count(x) for x in kind)

    def single(self, held: tuple[int, ...], gap: int) -> tuple[int, ...] | None:
        return (*held, gap) if self._available((*held, gap)) else None

    def pair(self, held: tuple[int, ...], gap: int) -> tuple[int, ...] | None:
        found = self.pairs.get(gap, [])
        while found and not (self.counts[found[0][0]] and self.counts[found[0][1]]):
            found.pop(0)  # used up for good
        return next((kind for two in found if self._available(kind := (*held, *two))), None)

    def triple(self, held: tuple[int, ...], gap: int) -> tuple[int, ...] | None:
        self.present = [x for x in self.present if self.counts[x]]
        found = (self.pair((*held, x), gap - x) for x in self.present if x < gap)
        return next((kind for kind in found if kind), None)


def pack_counts(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Kinds of sequences (lengths in order) and how many of each, for so many pieces of each length."""
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} tokens doesn't fit {capacity}")
        counts[length] = n
    plan: list[tuple[tuple[int, ...], int]] = []
    if counts[capacity]:
        plan.append(((capacity,), counts[capacity]))
        counts[capacity] = 0
    sums = _Sums(counts)
    for find in (sums.single, sums.pair, sums.triple):
        for length in range(capacity - 1, 0, -1):
            while counts[length]:
                kind = find((length,), capacity - length)
                if kind is None:
                    break
                times = min(counts[x] // kind.count(x) for x in kind)
                for x in kind:
                    counts[x] -= times
                plan.append((kind, times))
    open_kinds: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in range(capacity - 1, 0, -1):
        while counts[length]:
            gap = min((g for g, kinds in open_kinds.items() if kinds and g >= length), default=None)
            if gap is None:
                each = capacity // length
                whole, rest = divmod(counts[length], each)
                for held, times in ((each, whole), (rest, 1)):
                    if held and times:
                        open_kinds[capacity - held * length].append(((length,) * held, times))
                counts[length] = 0
            else:
                kind, times = open_kinds[gap].pop()
                used = min(times, counts[length])
                if times > used:
                    open_kinds[gap].append((kind, times - used))
                open_kinds[gap - length].append(((*kind, length), used))
                counts[length] -= used
    return plan + [kind for kinds in open_kinds.values() for kind in kinds]


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), by length and rank."""
    used: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for kind, times in plan:
        offset = 0
        for length in kind:
            rows.append((length, used[length], first, offset))
            used[length] += times
            offset += length
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def place(pieces: DataFrame, capacity: int = CAPACITY, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ...) with sequence_id and offset. Read it several times: store it first."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(pack_counts(histogram, capacity))
    parts = F.array(*[F.lit(max(1, -(-histogram.get(x, 0) // rows_per_part))) for x in range(1, capacity + 1)])
    keyed = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "start"), F.element_at(parts, F.col("length").cast("int"))))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "start")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = keyed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = keyed.withColumn("rank", F.row_number().over(order)).join(sizes, ["length", "part"])
    ranked = ranked.select(*[F.col(f"`{c}`") for c in pieces.columns], (F.col("rank") - 1 + F.col("before")).alias("rank"))
    shared = spark.sparkContext.broadcast(slots)  # bounded by the number of plan entries
    at, width = len(pieces.columns), 40

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        keys = (slots[:, 0] << width) | slots[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (by_name, at))
            found = slots[np.searchsorted(keys, (length << width) | rank, side="right") - 1]
            columns = [*batch.columns[:at], pa.array(found[:, 2] + rank - found[:, 1]), pa.array(found[:, 3])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    by_name = pieces.columns.index("length")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id bigint, offset bigint"
    names = [*pieces.columns, "sequence_id", "offset"]
    return ranked.mapInArrow(run, ddl)


def pack(docs: DataFrame, tokenizer_file: str, end_id: int, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` with their places; ``sequences`` puts them together."""
    return place(stored(token_pieces(docs, tokenizer_file, end_id, capacity, ids), "token-pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids: the packed sequences themselves, from pieces placed with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (
        placed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
    )


def production_pack(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, folder):
    """All documents in as few sequences of at most 1024 tokens as the plan finds."""
    return production_pack(table(spark, folder, "documents").select("doc_id", "text"))
