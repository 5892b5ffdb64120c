"""Periodic runs of words by Baier's grouping of suffixes.

A run is a stretch of words with smallest period q that no neighbouring word extends keeping q. By the runs
theorem its Lyndon root (the stretch of q words that is smaller than all its proper suffixes) is, in one of the
two opposite orders of the words, the longest Lyndon word at each place where it occurs within the run. So two
Lyndon arrays give all runs:

* ``lyndon_groups`` is phase one of Baier's suffix sorter. Suffixes are grouped by their first word; groups are
  taken from the highest down, and the nearest suffix before a member that lies in a lower group moves to a new
  group right above its own, its context lengthened by the member's context as often as members name it. In the
  end the length of a group's context is the longest Lyndon word of its members, and members of one group share
  that word: the sorter's second phase isn't needed. Every suffix is a member once and pushes at most one other.
* A run of exponent 4 holds its root at least three times in a row. ``found_runs`` takes the first place of every
  chain of three neighbouring equal roots and extends it to both sides by longest common extensions, which
  compare slices of doubling length and then halve them.

Words that occur fewer than four times in a stretch lie in no run of exponent 4 within it, so a text is first cut
at them, again and again (``repetitive``); what lies between is examined whole. Runs never reach over a cut: a
word that would extend one equals a word of the run.

Work is per row: no shuffle, and a task holds one batch of texts. Defined results: a null text has no words;
white space is the six ASCII characters alone; repeated rows give repeated results; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import query, table

EXPONENT, SHORTEST = 4, 6
CUT_ROUNDS = 16  # of cutting a text at rare words; what is then left is examined as it is


def lyndon_groups(word: list[int], letters: int) -> tuple[list[int], list[int]]:
    """For each place its group and, by group, the length of the longest Lyndon word that its members begin with.

    ``word`` holds ranks below ``letters``; the end of the text is smaller than every rank.
    """
    n = len(word)
    group, members = list(word), [[] for _ in range(letters)]
    for i, c in enumerate(word):
        members[c].append(i)
    length = [1] * letters
    below, above = list(range(-1, letters - 1)), [*range(1, letters), -1]
    before, done = [-1] * n, bytearray(n)
    now = letters - 1
    while now >= 0:
        own = [i for i in members[now] if group[i] == now]  # others have moved on
        for i in own:
            done[i] = 1
        named: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and done[j]:
                j = before[j]
            before[i] = j
            if j >= 0:
                named[j] = named.get(j, 0) + 1
        if named:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in named.items():
                moved.setdefault((times, group[j]), []).append(j)
            for (times, old), places in sorted(moved.items(), key=lambda x: -x[0][0]):
                new = len(members)
                members.append(places)
                length.append(length[old] + times * length[now])
                upper = above[old]
                above.append(upper)
                below.append(old)
                above[old] = new
                if upper >= 0:
                    below[upper] = new
                for j in places:
                    group[j] = new
        now = below[now]
    return group, length


def common_after(word: list[int], i: int, j: int) -> int:
    """Number of equal words from i on and from j on, i < j."""
    n, same, step = len(word), 0, 8
    while j + same < n:
        step = min(step, n - j - same)
        if word[i + same : i + same + step] == word[j + same : j + same + step]:
            same, step = same + step, step * 2
        elif step == 1:
            break
        else:
            step = (step + 1) // 2
            while step > 1 and word[i + same : i + same + step] != word[j + same : j + same + step]:
                step = (step + 1) // 2
            if word[i + same : i + same + step] != word[j + same : j + same + step]:
                break
            same += step
    return same


def common_before(word: list[int], i: int, j: int) -> int:
    """Number of equal words up to before i and up to before j, i < j."""
    same = 0
    while same < i and word[i - same - 1] == word[j - same - 1]:
        same += 1
    return same


def found_runs(word: list[int], letters: int, exponent: int = EXPONENT, shortest: int = SHORTEST) -> set[tuple[int, int, int]]:
    """(start, length, period) of every run of ``word`` with that exponent and length at least; exponent >= 4."""
    found: set[tuple[int, int, int]] = set()
    n = len(word)
    for text in (word, [letters - 1 - c for c in word]):
        group, length = lyndon_groups(text, letters)
        at = np.array(group)
        period = np.array(length)[at]
        place = np.arange(n)
        inside = place + 2 * period < n
        first = place[inside]
        step = period[inside]
        chain = (at[first] == at[first + step]) & (at[first] == at[first + 2 * step])
        head = np.where(first >= step, at[first - step] != at[first], True)
        for i, q in zip(first[chain & head].tolist(), step[chain & head].tolist(), strict=True):
            start = i - common_before(word, i, i + q)
            size = i + q + common_after(word, i, i + q) - start
            if size >= max(shortest, exponent * q):
                found.add((start, size, q))
    return found


def repetitive(word: list, times: int = EXPONENT, shortest: int = SHORTEST) -> Iterator[tuple[int, int]]:
    """Stretches (from, to) outside of which no word can be part of a run of that exponent."""
    todo = [(0, len(word), 0)]
    while todo:
        low, high, depth = todo.pop()
        own = word[low:high]
        rare = {w for w, k in Counter(own).items() if k < times} if depth < CUT_ROUNDS else ()
        if not rare:
            yield low, high
            continue
        start = low
        for i, w in enumerate(own, low):
            if w in rare:
                if i - start >= shortest:
                    todo.append((start, i, depth + 1))
                start = i + 1
        if high - start >= shortest:
            todo.append((start, high, depth + 1))


def text_runs(words: list, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of a list of words, by start, then period."""
    found = []
    for low, high in repetitive(words, exponent, shortest):
        if high - low >= shortest:
            rank: dict = {}
            ranks = [rank.setdefault(w, len(rank)) for w in words[low:high]]  # any order of words will do
            found += [(start + low, size, q) for start, size, q in found_runs(ranks, len(rank), exponent, shortest)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = bytearray(b"\1") * len(words)
    for start, size, q in runs:
        keep[start + q : start + size] = bytes(size - q)
    return b" ".join([w for w, k in zip(words, keep, strict=True) if k])


Change = Callable[[object, list[bytes]], list[bytes]]


def periodic_runs(docs: DataFrame, change: Change | None = None, texts: bool = False) -> DataFrame:
    """doc_id, n_runs, the longest run and digests for every row of ``docs`` (doc_id, text).

    ``change`` may alter the words of a document, given its id, before they are searched. ``texts`` adds
    ``runs`` (array of start, length, period) and ``collapsed``, the text without the repetitions.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = ["n_runs", "start", "length", "period", "exponent_milli"]
    ddl = f"doc_id {kind}, " + ", ".join(f"{x} bigint" for x in fields) + ", runs_sha256 string, collapsed_sha256 string"
    if texts:
        ddl += ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, digests, kept = [[] for _ in fields], ([], []), ([], [])
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                words = (text.as_py() or b"").split()  # of bytes: at the six ASCII characters only
                if change is not None:
                    words = change(doc.as_py(), words)
                runs = text_runs(words)
                start, size, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                for column, value in zip(numbers, (len(runs), start, size, q, 1000 * size // q if runs else None), strict=True):
                    column.append(value)
                short = collapsed(words, runs)
                digests[0].append(hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest())
                digests[1].append(hashlib.sha256(short).hexdigest())
                if texts:
                    kept[0].append([{"start": a, "length": b, "period": c} for a, b, c in runs])
                    kept[1].append(short.decode())
            columns = [batch.column(0), *[pa.array(x, pa.int64()) for x in numbers], *[pa.array(x, pa.string()) for x in digests]]
            names = ["doc_id", *fields, "runs_sha256", "collapsed_sha256"]
            if texts:
                triple = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])
                columns += [pa.array(kept[0], pa.list_(triple)), pa.array(kept[1], pa.string())]
                names += ["runs", "collapsed"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, ddl)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by a checksum of its id, goes on with its own words of one period from some word on."""
    import zlib

    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    piece = words[a : a + p]
    return words[:a] + (piece * ((n - a) // p + 1))[: n - a]


@query("op13_lyndon_runs")
def op13_lyndon_runs(spark, folder):
    """Runs of words of every whole text, and the digest of the text without their repetitions."""
    return periodic_runs(table(spark, folder, "documents").select("doc_id", "text"), planted)
