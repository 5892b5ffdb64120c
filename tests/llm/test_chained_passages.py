"""Passages: chains against a quadratic recurrence, planted passages found where they are, clean texts left alone."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugework.llm import chained_passages as cp
from gaugework.llm.common import QUERIES
from gaugework.llm.words import WORD, word_hashes

DDL = "doc_id long, text string, node string"


def test_chains_equal_quadratic_recurrence():
    draw = np.random.default_rng(0)
    for _ in range(40):
        n = int(draw.integers(1, 60))
        pairs = np.unique(draw.integers(0, 80, (n, 2)), axis=0)
        p, q = pairs[:, 0], pairs[:, 1]
        value = np.zeros(len(p))
        for i in np.lexsort((-q, p)):
            before = [value[j] - 0.1 * (p[i] - p[j] + q[i] - q[j]) for j in range(len(p)) if p[j] < p[i] and q[j] < q[i]]
            value[i] = 5 + max([0, *before])
        first = cp.chains(p, q)[0]
        assert np.isclose(value.max(), 5 * len(first) - 0.1 * (p[first[-1]] - p[first[0]] + q[first[-1]] - q[first[0]]))
        assert (np.diff(p[first]) > 0).all() and (np.diff(q[first]) > 0).all()
        assert sorted(i for path in cp.chains(p, q) for i in path) == list(range(len(p)))


def test_longest_common_subsequence():
    draw = np.random.default_rng(1)
    for _ in range(50):
        a, b = draw.integers(0, 4, draw.integers(0, 12)), draw.integers(0, 4, draw.integers(0, 12))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        assert cp._matches(a, b) == table[-1, -1]


def planted():
    draw = random.Random(4)

    def word():
        return f"w{draw.randrange(3000)}"

    def prose(n):
        return [word() for _ in range(n)]

    exact, fuzzy = prose(70), prose(120)
    docs, where = {}, {}
    for i in range(30):
        docs[i] = prose(draw.choice([60, 200, 500]))
    for i in range(100, 112):  # the same passage
        head = prose(draw.randrange(80))
        docs[i], where[i] = head + exact + prose(draw.randrange(80)), (len(head), len(head) + 70)
    for i in range(200, 206):  # one word in twelve replaced
        head, body = prose(draw.randrange(80)), list(fuzzy)
        for k in range(draw.randrange(12), len(body), 12):
            body[k] = word()
        docs[i], where[i] = head + body + prose(draw.randrange(80)), (len(head), len(head) + 120)
    docs[300], docs[301] = docs[0][:30], docs[1][:30]  # too short
    two = prose(60), prose(60)  # two passages with other words between
    docs[400], docs[401] = two[0] + prose(40) + two[1], two[0] + prose(90) + two[1]
    return {i: " ".join(x) for i, x in docs.items()}, where


def test_planted_passages(spark):
    docs, where = planted()
    rows = [(i, t, "clash") for i, t in docs.items()]
    got = cp.passages(spark.createDataFrame(rows, DDL)).collect()
    assert {i for r in got for i in (r.doc_id, r.src_doc_id)} == set(where) | {400, 401}
    for group in (range(100, 112), range(200, 206)):
        root = {i: i for i in group}
        for r in got:
            if r.doc_id in root:
                assert r.src_doc_id in root
                for doc, start, stop in ((r.doc_id, r.start, r.stop), (r.src_doc_id, r.src_start, r.src_stop)):
                    low, high = where[doc]
                    assert abs(start - low) <= 12 and abs(stop - high) <= 12
                a, b = r.doc_id, r.src_doc_id
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
        assert sum(root[i] == i for i in root) == 1  # all occurrences hang together
    assert sorted((r.stop - r.start) for r in got if {r.doc_id, r.src_doc_id} == {400, 401}) == [60, 60]


def test_common_seeds_are_dealt_into_parts(spark):
    draw = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"x{draw.randrange(10**6)}" for _ in range(20)), None) for i in range(120)]
    got = cp.passages(spark.createDataFrame(rows, DDL), sampled=1, rows_per_part=10).collect()
    root = list(range(120))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in got:
        assert r.start == r.src_start == 0 and 60 <= r.stop <= 61
        a, b = sorted((find(r.doc_id), find(r.src_doc_id)))
        root[b] = a
    assert len({find(i) for i in range(120)}) == 1 and len(got) < 120 * 12


def test_awkward_rows(spark):
    long = " ".join(f"l{i}" for i in range(30_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, "short", None), (4, long, "x"), (5, long.upper(), "x"), (5, long.upper(), "x"), (None, long, None), (6, "same " * 5000, "x"), (7, "same " * 4000, "x")]
    docs = spark.createDataFrame(rows, DDL)
    got = sorted((str(r.doc_id), r.start, r.stop, r.src_doc_id, round(r.similarity, 2)) for r in cp.passages(docs).collect())
    assert [x for x in got if x[3] == 4] == [("5", 0, 30_000, 4, 1.0), ("5", 0, 30_000, 4, 1.0), ("None", 0, 30_000, 4, 1.0)]
    assert {x[0] for x in got} <= {"5", "None", "6", "7"}
    assert cp.passages(docs.limit(0)).count() == 0


def test_query_reports_equal_words(spark, small):
    texts = {r.doc_id: WORD.findall((r.text or "").lower()) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op10_chained_passages"](spark, small).collect():
        a, b = texts[r.doc_id][r.start : r.stop], texts[r.src_doc_id][r.src_start : r.src_stop]
        assert min(len(a), len(b)) >= 50 and r.similarity >= 0.8 and len(set(a) & set(b)) >= 0.6 * len(set(a))


def test_anchors_in_line_take_the_short_way():
    draw = np.random.default_rng(3)
    for _ in range(40):
        n = int(draw.integers(2, 40))
        p, q = np.cumsum(draw.integers(1, 40, n)), np.cumsum(draw.integers(1, 40, n))
        value = np.full(n, 5.0)
        for i in range(n):
            value[i] += max([0, *(value[j] - 0.1 * (p[i] - p[j] + q[i] - q[j]) for j in range(i))])
        paths = cp.chains(p, q)
        first = paths[0]
        assert np.isclose(value.max(), 5 * len(first) - 0.1 * (p[first[-1]] - p[first[0]] + q[first[-1]] - q[first[0]]))
        assert sorted(i for path in paths for i in path) == list(range(n))


@pytest.mark.parametrize("size", [12, 20, 30])
def test_passages_of_frequent_lines(spark, size):
    draw = random.Random(size)
    lines = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(size)) for _ in range(300)]

    def prose(n):
        return " ".join(f"v{draw.randrange(10**6)}" for _ in range(n))

    rows = [(i, " ".join(f"{draw.choice(lines)} {prose(20)}" for _ in range(4))) for i in range(1500)]
    for k in range(20):
        shared = " ".join(draw.sample(lines, -(-60 // size)))
        rows += [(5000 + 2 * k + j, f"{prose(30)} {shared} {prose(30)}") for j in (0, 1)]
    got = {frozenset((r.doc_id, r.src_doc_id)) for r in cp.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(frozenset((5000 + 2 * k, 5001 + 2 * k)) in got for k in range(20)) == 20


def test_pair_whose_every_stretch_is_in_other_texts(spark):
    """Texts that differ between the lines they share; either one's lines with the words between them are in 20 others."""
    draw = random.Random(7)

    def prose(n):
        return " ".join(f"v{draw.randrange(10**6)}" for _ in range(n))

    rows, pairs = [], []
    for k in range(8):
        lines = [prose(12) for _ in range(5)]
        for own in (100_000 + 2 * k, 100_001 + 2 * k):
            gaps = [prose(1) for _ in range(4)]
            body = " ".join(x for pair in zip(lines, [*gaps, ""], strict=True) for x in pair)
            rows.append((own, f"{prose(30)} {body} {prose(30)}"))
            rows += [(len(rows), f"{prose(30)} {lines[i]} {gaps[i]} {lines[i + 1]} {prose(30)}") for i in range(4) for _ in range(20)]
        pairs.append(frozenset((100_000 + 2 * k, 100_001 + 2 * k)))
    got = {frozenset((r.doc_id, r.src_doc_id)) for r in cp.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(pairs)


def test_texts_are_read_once(spark):
    draw, read = random.Random(9), spark.sparkContext.accumulator(0)
    line = " ".join(f"l{i}" for i in range(12))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join([f"x{draw.randrange(10**6)}" for _ in range(60)] + [line, passage if i % 3 == 0 else ""])) for i in range(90)]

    def counted(text):
        read.add(1)
        return text

    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", F.udf(counted, "string")("text"))
    got = cp.passages(docs).collect()
    assert {i for r in got for i in (r.doc_id, r.src_doc_id)} == set(range(0, 90, 3))
    assert read.value == len(rows)


def test_word_hashes_tell_words_apart():
    draw = random.Random(10)
    texts = ["", None, "Hello, WORLD hello", "straße ΑΣ ΑΣΑ x_y 12½ ǅ", "a" * 60 + " b " + "a" * 61, "\n\n", "\ud800 z", "İi 𝒳𝒴 𐐀𐐨", "_ __"]
    texts += [" ".join("".join(draw.choices("abAB_9 é\n", k=draw.randrange(9))) for _ in range(3000)) for _ in range(20)]
    texts += ["ab " * 50_000, "x" * 200_000 + " y", "z" * (1 << 16), "q" * 65_530 + " rstuvwxyz ab"]
    hashes, sizes = word_hashes(texts)
    words = [WORD.findall((x or "").lower()) for x in texts]
    assert sizes.tolist() == [len(x) for x in words]
    pairs = set(zip((w for x in words for w in x), hashes.tolist(), strict=True))
    assert len(pairs) == len({w for w, _ in pairs}) == len({h for _, h in pairs})
    assert np.array_equal(np.concatenate([word_hashes([x])[0] for x in texts]), hashes)


def test_minimizers_of_several_texts():
    draw = np.random.default_rng(11)
    for window in (1, 2, 7, 10):
        for _ in range(50):
            sizes = draw.integers(0, 40, draw.integers(1, 8))
            keys = draw.integers(0, draw.integers(2, 50), sizes.sum()).astype(np.uint64)
            want, low = [], 0
            for n in sizes.tolist():
                own = keys[low : low + n]
                want += sorted({low + i + int(np.argmin(own[i : i + window])) for i in range(max(1, n - window + 1))} if n else ())
                low += n
            assert cp.minimizers(keys, window, sizes).tolist() == want


@pytest.mark.parametrize("one_block", [True, False])
def test_rare_words_lose_no_pair(one_block):
    """Rows with words at equal places of which some are in most rows: every pair with 40 equal words of 50 is returned."""
    draw = np.random.default_rng(12)
    base = draw.integers(2, 10**9, (40, 95)).astype(np.uint32)
    rows = [np.where(draw.random((400, 95)) < 0.5, base[0], draw.integers(2, 30, (400, 95)).astype(np.uint32))]
    rows += [np.where(draw.random(95) < share, base[k], draw.integers(2, 10**9, 95).astype(np.uint32))[None] for k in range(40) for share in (0.75, 0.9, 1)]
    rows = np.concatenate(rows)
    rows[:, 45:50] = 7  # the common seed
    rows[::9, :20] = 0  # a text begins there
    both = [rows, rows] if one_block else [rows[::2], rows[1::2]]
    both[1] = np.where(both[1] == 0, 1, both[1])
    near = cp._by_rare_words(both, 50, 40, one_block)
    returned = 0
    for side in (0, 1):
        for i, row in enumerate(both[side]):
            total = np.cumsum(np.concatenate([np.zeros((len(both[1 - side]), 1), int), both[1 - side] == row], axis=1), axis=1)
            alike = set(np.nonzero((total[:, 50:] - total[:, :-50]).max(axis=1) >= 40)[0].tolist()) - ({i} if one_block else set())
            found = set(near(side, i).tolist())
            assert alike <= found
            returned += len(found)
    assert returned < 0.5 * 2 * len(both[0]) * len(both[1])


def test_passage_goes_on_without_seeds(spark):
    """Thirty equal words, then two hundred of which every fifth differs: no seed, but the passage doesn't end there."""
    draw = random.Random(13)
    own = [f"w{i}" for i in range(230)]
    other = [x if i < 30 or i % 5 else f"y{i}" for i, x in enumerate(own)]
    rows = [(i, " ".join([f"x{draw.randrange(10**6)}" for _ in range(40)] + x + [f"x{draw.randrange(10**6)}" for _ in range(40)])) for i, x in enumerate((own, other, own[::-1], other[::-1]))]
    got = sorted((r.doc_id, r.src_doc_id, r.stop - r.start) for r in cp.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert [{*r[:2]} for r in got] in ([{0, 1}, {2, 3}], [{2, 3}, {0, 1}]) and all(220 <= r[2] <= 232 for r in got)
