"""Byte-level BPE in two tiers.

Tier one: a minimal perfect hash over the vocabulary (one slot per token, one displacement per bucket of
keys) answers whole pre-tokens that are tokens themselves. Tier two: other pre-tokens are bytes in a
doubly linked list; a heap of (rank, position) yields the lowest mergeable pair, leftmost first, in
O(n log n) for a pre-token of n bytes.

Defined results: a null text counts as empty and gives no ids; rows repeat as they come; an empty table
gives an empty result; only doc_id and text are read, further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import query, table, text_or_empty
from .pieces import PieceEncoder

_MASK = (1 << 64) - 1


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes -> rank from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


class PerfectHash:
    """Minimal perfect hash of a fixed set of byte strings: n keys, n slots.

    Keys are dealt into buckets; large buckets first, each takes the first displacement that sends all its
    keys to free slots; buckets of one key name their slot directly (as a negative displacement).
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 4):
        self.n, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        dealt: list[list[bytes]] = [[] for _ in range(self.buckets)]
        for key in keys:
            dealt[xxhash.xxh3_64_intdigest(key) % self.buckets].append(key)
        self.shift = np.zeros(self.buckets, dtype=np.int32)
        slots: list[bytes | None] = [None] * self.n
        order = sorted(range(self.buckets), key=lambda b: -len(dealt[b]))
        singles = next((i for i, b in enumerate(order) if len(dealt[b]) <= 1), self.buckets)
        for b in order[:singles]:
            hashes = [xxhash.xxh3_64_intdigest(k) for k in dealt[b]]
            shift = 1
            while True:
                places = [self._place(h, shift) for h in hashes]
                if len(set(places)) == len(places) and all(slots[p] is None for p in places):
                    break
                shift += 1
            self.shift[b] = shift
            for place, key in zip(places, dealt[b], strict=True):
                slots[place] = key
        free = iter([p for p, key in enumerate(slots) if key is None])
        for b in order[singles:]:
            if dealt[b]:
                place = next(free)
                self.shift[b], slots[place] = -place - 1, dealt[b][0]
        self.slots: list[bytes] = slots  # type: ignore[assignment]
        self.shift = self.shift.tolist()

    def _place(self, h: int, shift: int) -> int:
        x = ((h ^ (shift * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & _MASK
        return (x >> 31) % self.n

    def find(self, key: bytes) -> int:
        """Slot of ``key``, or -1 if it isn't in the set."""
        if not self.n:
            return -1
        h = xxhash.xxh3_64_intdigest(key)
        shift = self.shift[h % self.buckets]
        place = -shift - 1 if shift < 0 else self._place(h, shift)
        return place if self.slots[place] == key else -1


class TwoTier:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.hash = PerfectHash(list(ranks))
        self.ids = [ranks[key] for key in self.hash.slots]
        self.tokens = {rank: token for token, rank in ranks.items()}

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token that isn't in the vocabulary."""
        ranks, n = self.ranks, len(word)
        part = [word[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, 2) for i in range(n - 1) if (rank := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if part[i] else n
            if j >= n or len(part[i]) + len(part[j]) != size:
                continue  # one of the two has been merged since
            part[i] += part[j]
            part[j] = b""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := ranks.get(part[i] + part[k])) is not None:
                    heapq.heappush(heap, (rank, i, len(part[i]) + len(part[k])))
            h = before[i]
            if h >= 0 and (rank := ranks.get(part[h] + part[i])) is not None:
                heapq.heappush(heap, (rank, h, len(part[h]) + len(part[i])))
        return [ranks[x] for x in part if x]

    def word(self, word: bytes) -> list[int]:
        place = self.hash.find(word)
        return [self.ids[place]] if place >= 0 else self.merge(word)

    def encode_piece(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        ids = [i for match in self.pattern.findall(text) for i in self.word(match.encode())]
        return np.array(ids, dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_MADE: dict[bytes, tuple[TwoTier, PieceEncoder]] = {}


def _codec(lines: bytes, pattern: str) -> tuple[TwoTier, PieceEncoder]:
    """One encoder per Python worker and vocabulary."""
    key = hashlib.sha256(lines + pattern.encode()).digest()
    if key not in _MADE:
        codec = TwoTier(read_ranks(lines), pattern)
        _MADE[key] = codec, PieceEncoder(codec.encode_piece)
    return _MADE[key]


def encode(docs: DataFrame, rank_file: str, pattern: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for every row of ``docs`` (doc_id, text).

    ``ids`` adds the token ids and ``decoded``, the text that the ids give back. ``rank_file`` is a file
    on the driver; its bytes travel with the tasks.
    """
    with open(rank_file, "rb") as f:
        lines = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, encoder = _codec(lines.value, pattern)
        for batch in batches:
            doc, count, coded, back, kept = batch.column(0), [], [], [], ([], [])
            for text in batch.column(1):
                found = encoder(text.as_py())
                decoded = codec.decode(found)
                count.append(len(found) // 4)
                coded.append(hashlib.sha256(found).hexdigest())
                back.append(hashlib.sha256(decoded).hexdigest())
                if ids:
                    kept[0].append(np.frombuffer(found, dtype="<u4").astype(np.int32))
                    kept[1].append(decoded.decode("utf-8", "replace"))
            columns = [doc, pa.array(count, pa.int64()), pa.array(coded, pa.string()), pa.array(back, pa.string())]
            if ids:
                columns += [pa.array(kept[0], pa.list_(pa.int32())), pa.array(kept[1], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if ids else "")
    names = [x.split()[0] for x in ddl.split(", ")]
    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, ddl)


@query("op8_bpe_codec")
def op8_bpe_codec(spark, folder):
    """Ids of every whole text by the multilingual vocabulary, decoded again."""
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", F.col("text"))
    return encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
