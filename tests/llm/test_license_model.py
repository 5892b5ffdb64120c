"""Licence scan: template lines found and named, prose left alone, natively planned."""

import re

import pytest

from gaugework.llm import license_model as lm
from gaugework.llm.common import QUERIES

DDL = "doc_id long, text string, paragraph string"
LINES = {
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "This work is licensed under the GNU General Public License, version 3.": "gpl",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "Released under the MIT License.": "mit",
}


@pytest.fixture(scope="module")
def model(spark):
    return lm.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_query_finds_all_licence_lines(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    want = {(i, k, LINES[line]) for i, t in texts.items() for k, line in enumerate((t or "").split("\n")) if line in LINES}
    rows = QUERIES["op9_license_paragraphs"](spark, folder).collect()
    got = {(r.doc_id, r.paragraph, r.licence) for r in rows if r.confirmed}
    assert want <= got
    assert all(re.search("(?i)licen", texts[i].split("\n")[k]) for i, k, _ in got)


def test_paraphrases_and_prose(spark, model):
    texts = {
        1: "This project is released under the MIT License, see below.\nThe licence of this poem is that it may rhyme.",
        2: "You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3",
        3: "The cat sat under the table, version of the story unknown.",
        4: "Source code is subject to the terms of the Mozilla Public License, v. 2.0.",
    }
    got = {(r.doc_id, r.paragraph): (r.licence, r.confirmed) for r in lm.scan(spark.createDataFrame([(i, t, "x") for i, t in texts.items()], DDL), model).collect()}
    assert got[1, 0] == ("mit", True) and got[2, 0] == ("gpl", True) and got[4, 0] == ("mpl-2.0", True)
    assert not any(v[1] for k, v in got.items() if k not in {(1, 0), (2, 0), (4, 0)})


def test_awkward_rows(spark, model):
    line = "Released under the MIT License."
    rows = [(1, None, "x"), (2, "", "x"), (3, "\n\n", None), (None, line, "x"), (4, "word " * 60_000 + "\n" + line, "x"), (5, line, "x"), (5, line, "x")]
    docs = spark.createDataFrame(rows, DDL)
    found = lm.scan(docs, model)
    assert sorted((str(r.doc_id), r.paragraph, r.licence, r.confirmed) for r in found.collect()) == [("4", 1, "mit", True), ("5", 0, "mit", True), ("None", 0, "mit", True)]
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    empty = docs.limit(0)
    assert lm.scan(empty, lm.fit(empty)).count() == 0
