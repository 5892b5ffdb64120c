"""BagMinHash: signatures estimate the weighted overlap, classes equal those of all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from gaugework.llm import bag_minhash
from gaugework.llm.common import QUERIES
from gaugework.llm.components import components

DDL = "doc_id long, text string, root string"


def bag(text):
    w = re.findall(r"\w+", (text or "").lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(rows, threshold=0.8):
    """doc_id -> class_id by comparing all pairs."""
    bags, root = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    seen = {}
    for i, b in enumerate(bags):
        for k in b:
            for j in seen.setdefault(k, []):
                if find(i) != find(j) and sum((b & bags[j]).values()) / sum((b | bags[j]).values()) >= threshold:
                    root[find(i)] = find(j)
            seen[k].append(i)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc)
    return {doc: min(ids[find(i)]) for i, (doc, _) in enumerate(rows)}


@pytest.mark.parametrize("most", [1, 9])
def test_signatures_are_unbiased(most):
    draw = np.random.default_rng(1)
    agree, exact = [], []
    for _ in range(30):
        keys = np.unique(draw.integers(0, 2**63, 120).astype(np.uint64))
        a, b = draw.integers(0, most + 1, len(keys)), draw.integers(0, most + 1, len(keys))
        a[:60] = b[:60]
        one, two = (bag_minhash.signature(keys[x > 0], x[x > 0], 400) for x in (a, b))
        agree.append((one == two).mean())
        exact.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(agree) - np.mean(exact)) < 0.01
    assert np.abs(np.array(agree) - exact).max() < 0.12


def near(text, draw, share):
    words = text.split()
    for i in draw.sample(range(len(words)), max(1, int(len(words) * share))):
        words[i] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


def corpus():
    draw = random.Random(3)
    rows = [(i, " ".join(f"a{draw.randrange(5000)}" for _ in range(draw.choice([6, 40, 200, 600])))) for i in range(60)]
    base = rows[3][1] + " " + rows[5][1] + " middle " * 50
    rows += [(100 + i, near(base, draw, 0.01 + 0.02 * (i % 4))) for i in range(40)]
    chain = rows[7][1] + rows[8][1] + " ".join(f"c{i}" for i in range(300))
    for i in range(12):
        chain = near(chain, draw, 0.015)
        rows.append((200 + i, chain))
    rows += [(300 + i, rows[2][1].upper() + "!" * i) for i in range(5)]
    rows += [(400, None), (401, ""), (402, " ... "), (403, "two words"), (404, "two, words"), (405, "x " * 40_000), (406, "x " * 39_000)]
    return rows


def test_classes_equal_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], DDL)
    got = {r.doc_id: r for r in bag_minhash.near_classes(docs).collect()}
    want = brute(rows) | {400: 400, 401: 401, 402: 402}
    assert {i: r.class_id for i, r in got.items()} == want
    assert all(r.kept == (i == r.class_id) and r.class_size == list(want.values()).count(r.class_id) for i, r in got.items())
    left = bag_minhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_last_comparison_alone_finds_all_links(spark, monkeypatch):
    """Without stars and with small blocks, everything is left to the comparison within buckets."""
    monkeypatch.setattr(bag_minhash.near_components, "__defaults__", (0.8, 0, 3))
    rows = [r for r in corpus() if r[0] >= 100 and r[0] < 400]
    docs = spark.createDataFrame([(i, t, None) for i, t in rows], DDL)
    assert {r.doc_id: r.class_id for r in bag_minhash.near_classes(docs).collect()} == brute(rows)


def test_awkward_tables(spark):
    docs = spark.createDataFrame([(None, "a b c d e f", "x"), (5, "a b c d e f", None), (5, "a b c d e f", None), (None, None, None)], DDL)
    got = bag_minhash.near_classes(docs).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size, r.kept) for r in got) == [
        ("5", "5", 3, True), ("5", "5", 3, True), ("None", "5", 3, False), ("None", "None", 1, True),
    ]
    assert bag_minhash.near_classes(docs.limit(0)).count() == 0


def test_query_equals_all_pairs(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op6_bag_minhash"](spark, small).collect()}
    assert got == brute(rows)


def test_components(spark):
    draw = random.Random(5)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(90)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {x: find(x) for x in root if any(x in pair and pair[0] != pair[1] for pair in links)}
    assert components(frame.limit(0)).count() == 0
