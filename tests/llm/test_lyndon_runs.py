"""Runs by Lyndon roots against brute force over all periods."""

import hashlib
import random
import zlib

import pytest

from gaugework.llm.common import QUERIES
from gaugework.llm.lyndon_runs import collapsed, lyndon_groups, periodic_runs, text_runs

WHITE = " \t\n\x0b\x0c\r"


def brute(words):
    """All runs by the definition: for each period the maximal stretches, the smallest period of a stretch counts."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def longest_lyndon(word):
    out = []
    for i in range(len(word)):
        out.append(max(k for k in range(1, len(word) - i + 1) if all(word[i : i + k] < word[i + s : i + k] for s in range(1, k))))
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_groups_give_the_lyndon_array(letters):
    draw = random.Random(letters)
    for n in [1, 2, 3, 7, 12, 25, 40]:
        for _ in range(12):
            word = [draw.randrange(letters) for _ in range(n)]
            group, length = lyndon_groups(word, letters)
            want = longest_lyndon(word)
            assert [length[g] for g in group] == want
            words = [tuple(word[i : i + k]) for i, k in enumerate(want)]
            assert len(set(zip(group, words))) == len(set(group)) == len(set(words))


def texts(draw):
    for letters in (1, 2, 3, 5, 30):
        for n in (0, 1, 5, 6, 7, 24, 60, 150):
            yield [draw.randrange(letters) for _ in range(n)]
    for _ in range(150):
        word = []
        while len(word) < 120:
            piece = [draw.randrange(4) for _ in range(draw.randint(1, 7))]
            if draw.random() < 0.4:
                piece = piece * draw.randint(2, 4) + piece[: draw.randrange(len(piece))]
            word += piece * draw.randint(1, 6)
            word += piece[: draw.randrange(len(piece) + 1)]
        yield word


def test_runs_equal_brute_force():
    some = 0
    for word in texts(random.Random(5)):
        want = brute(word)
        assert text_runs(word) == want
        some += len(want)
    assert some > 500


def test_a_nested_run_and_its_period_are_both_found():
    inner = list("aaaaaa")
    word = (inner + ["b"]) * 4
    got = text_runs(word)
    assert (0, 28, 7) in got and sum(q == 1 for _, _, q in got) == 4
    assert got == brute(word)
    # of six a only the first stays, of four periods the first
    assert collapsed([x.encode() for x in word], got) == b"a b"


def test_long_periodic_text_is_linear():
    word = [i % 2000 for i in range(100_000)]
    assert text_runs(word) == [(0, 100_000, 2000)]
    assert text_runs([7] * 300_000) == [(0, 300_000, 1)]
    a, b = [0], [0, 1]  # a Fibonacci word has runs everywhere, but none of exponent 4
    while len(b) < 50_000:
        a, b = b, b + a
    assert text_runs(b) == []


def by_definition(doc_id, text):
    words, now = [], ""
    for c in (text or "") + " ":
        if c in WHITE:
            words += [now] if now else []
            now = ""
        else:
            now += c
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    longest = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_against_the_definition(spark, small):
    got = sorted(tuple(r) for r in QUERIES["op13_lyndon_runs"](spark, small).collect())
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(by_definition(d, t) for d, t in docs if t is None or len(t) < 12_000)
    some = {r[0] for r in want}
    assert [r for r in got if r[0] in some] == want
    assert len(got) == len(docs) and any(r[1] for r in want)


def test_edges(spark):
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \t\n ", None), (4, "a a a a a a", "x"), (4, "a a a a a a", "x"), (None, "b b b b b", "x"),
        (5, "no break no break no break no break no break no break", "x"), (6, "x y " * 40_000 + "x", "x"), (7, "é\u2003é " * 6, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    got = sorted(periodic_runs(docs, texts=True).collect(), key=repr)
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    for i in (1, 2, 3):
        assert tuple(by[i])[1:8] == (0, None, None, None, None, empty, empty) and by[i].collapsed == ""
    assert tuple(by[4])[1:6] == (1, 0, 6, 1, 6000) and by[4].collapsed == "a" and sum(r.doc_id == 4 for r in got) == 2
    assert by[None].n_runs == 0 and by[None].collapsed == "b b b b b"
    assert tuple(by[5])[1:6] == (1, 0, 6, 1, 6000)
    assert tuple(by[6])[1:6] == (1, 0, 80_001, 2, 40_000_500) and by[6].collapsed == "x y"
    assert tuple(by[7])[1:6] == (1, 0, 6, 1, 6000)  # an em space is no white space here
    assert periodic_runs(docs.limit(0)).collect() == []
