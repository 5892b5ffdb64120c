"""Exact copies: the query against SQL, and awkward rows against a plain loop."""

import hashlib
import re

import compare
import pytest

from gaugework.llm import content_sort
from gaugework.llm.common import ORACLES, QUERIES

AWKWARD = [
    (1, None, "x"),
    (2, "", "x"),
    (3, " \t\n", "y"),
    (4, "a b", None),
    (5, "ab", "y"),
    (6, "a  b", "y"),
    (6, "a  b", "y"),
    (None, "a b ", "z"),
    (8, "é b", "z"),
    (9, "éb", "z"),
    (10, "w " * 60_000, "z"),
    (11, "w" * 60_000, "z"),
    *[(100 + i, "hot text" + " " * (i % 3), "h") for i in range(40)],
]
DDL = "doc_id long, text string, place string"


def expected(rows):
    groups = {}
    for at, (i, text, *_) in enumerate(rows):
        body = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(body, []).append((-len(text or ""), i is None, i or 0, at))
    out = []
    for body, members in groups.items():
        members.sort()
        keep = rows[members[0][3]][0]
        digest = hashlib.sha256(body.encode()).hexdigest()
        out += [(rows[at][0], keep, len(members), n == 0, digest) for n, (*_, at) in enumerate(members)]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_piece", [3, 1000])
def test_awkward_rows(spark, rows_per_piece):
    docs = spark.createDataFrame(AWKWARD, DDL)
    got = content_sort.classes(docs, rows_per_piece)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(AWKWARD)
    kept = content_sort.drop_copies(docs.withColumn("digest", docs.place), rows_per_piece)
    assert kept.columns == ["doc_id", "text", "place", "digest"]
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(r[0]) for r in expected(AWKWARD) if r[3])


def test_empty_table(spark):
    docs = spark.createDataFrame([], DDL)
    assert content_sort.classes(docs).count() == 0
    assert content_sort.drop_copies(docs).count() == 0


def test_matches_sql(spark, small):
    con = compare.connect(small)
    assert compare.differences(QUERIES["op7_content_sort"](spark, small), con, ORACLES["op7_content_sort"]) == []


def test_text_is_moved_once(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    plan = content_sort._sorted_pieces(docs, [], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning(head" not in plan and "Python" not in plan
