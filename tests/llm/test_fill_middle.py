"""Fill-in-middle transformation against a walk over the characters, and its exact way back."""

import hashlib

import pytest
from pyspark.sql import functions as F

from gaugework.llm.common import QUERIES
from gaugework.llm.fill_middle import parts, restored, transform

WHITE = " \t\n\x0b\x0c\r"


def units(text):
    """A unit ends where white space follows other characters, or with the text."""
    out, now = [], ""
    for c in text:
        if now and c in WHITE and now[-1] not in WHITE:
            out.append(now)
            now = ""
        now += c
    return out + [now] if now else out


def by_definition(doc_id, text, seed=42, rate=50, suffix_first=80):
    text, digest = text or "", hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    own = units(text)
    a, b = sorted((h[0] % (len(own) + 1), h[1] % (len(own) + 1)))
    p, m, s = "".join(own[:a]), "".join(own[a:b]), "".join(own[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(own), "plain", None, text
    if h[3] % 100 < suffix_first:
        return len(own), "spm", (p, m, s), f"<S>{s}<P>{p}<M>{m}"
    return len(own), "psm", (p, m, s), f"<P>{p}<S>{s}<M>{m}"


def test_query_against_the_definition(spark, small):
    got = {r.doc_id: r for r in QUERIES["op11_counted_fill_middle"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs) and {r.form for r in got.values()} == {"plain", "spm", "psm"}
    for doc_id, text in docs:
        n, form, cut, output = by_definition(doc_id, text)
        chars = (len(cut[0]), len(cut[1])) if cut else (None, None)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (output, text or "")]
        assert tuple(got[doc_id]) == (doc_id, n, form, *chars, *digests)


ODD = [
    None, "", " ", "one", " one", "one ", "  one\n\ntwo\t", "\x0b\x0c\r\n", "a b c", "é 𝔘𝔫𝔦 😀 é", "x <P> y", "<M>", "a <S> b", "< < <P <", "P> S> M>",
    "<", "a <S", "M> b", "$1 \\ $3 (a) [b] {2}+ \\z", "line\nline\r\nline line", "x\x00y z", "w " * 100_000, "y" * 300_000, " " * 200_000 + "end", "end" + "\n" * 200_000,
]


@pytest.mark.parametrize(("rate", "suffix_first"), [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_odd_texts(spark, rate, suffix_first):
    rows = [(i, t, "x", "x", "x", 0) for i, t in enumerate(ODD * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output string, digest string, n int")
    found = transform(docs, rate=rate, suffix_first=suffix_first)
    found = found.select("*", restored(F.col("output"), F.col("form")).alias("back"), parts(F.col("output"), F.col("form")).alias("cut"))
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        n, form, cut, output = by_definition(i, text, rate=rate, suffix_first=suffix_first)
        assert (got[i].n, got[i].form, got[i].output, got[i].back) == (n, form, output, text or "")
        assert (tuple(got[i].cut) if cut else got[i].cut) == cut


def test_null_ids_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    got = transform(docs, rate=100).collect()
    assert len(got) == 4 and len(set(got)) == 2
    assert transform(docs.limit(0)).collect() == []


def test_no_shuffle_and_no_python(spark, small):
    plan = QUERIES["op11_counted_fill_middle"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Pandas"))
