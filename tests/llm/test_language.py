"""Language identification: held-out accuracy, counts against a loop, awkward rows."""

import re
import zlib
from collections import Counter

import numpy as np

from gaugework.llm import language
from gaugework.llm.common import QUERIES

DDL = "doc_id long, text string, lang string, score string"
EN, FR = "the cat and the dog sat on the mat with the others ", "le chat et le chien sont sur le tapis avec les autres "


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op4_word_backoff_language"](spark, folder).collect()
    assert len(got) == len(docs) and {r.lang_pred for r in got} <= {"en", "fr", "de", "es", "und"}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and docs[r.doc_id].lang]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


def test_model_counts_all_words(spark):
    docs = spark.createDataFrame([(i, EN if i % 2 else FR, "en" if i % 2 else "fr", "x") for i in range(20)], DDL)
    model = language.learn(docs)
    assert model.langs == ["en", "fr"]
    words = {"en": Counter(EN.split()), "fr": Counter(FR.split())}
    total = [10 * sum(words[x].values()) for x in model.langs]
    for word in ("the", "le", "cat"):
        want = [np.log((10 * words[x][word] + 0.5) / (t + 0.5 * len(words[x]) + 1)) for x, t in zip(model.langs, total, strict=True)]
        assert np.allclose(model.tables[0][word], want, atol=1e-5)
    grams = Counter()
    for word, n in words["en"].items():
        framed = f"<{word}>"
        for i in range(len(framed) - 2):
            grams[framed[i : i + 3]] += 10 * n
    want = np.log((grams["the"] + 0.5) / (sum(grams.values()) + 0.5 * len(grams) + 1))
    assert np.isclose(model.tables[3]["the"][0], want, atol=1e-5)
    assert model.unseen("thes")[0] > model.unseen("thes")[1]


def test_awkward_rows(spark):
    rows = [(i, EN * 3 if i % 2 else FR * 3, "en" if i % 2 else "fr", "x") for i in range(40)]
    rows += [(100, None, "en", "x"), (101, "", "en", "x"), (102, "12 + 3 _", "fr", None), (103, EN * 20_000, None, "x"), (None, FR, None, "x"), (104, None, None, None)]
    docs = spark.createDataFrame(rows, DDL)
    model = language.learn(language.learnt_from(docs))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert got[100] == got[101] == got[102] == got[104] == ("und", 0.0)
    assert got[103][0] == "en" and got[None][0] == "fr" and got[103][1] > 0.9
    left = language.keep(docs, model)
    assert left.schema.names == docs.columns
    assert {r.doc_id: r.lang for r in left.collect()} == {i: lang for i, (lang, _) in got.items() if lang != "und"}


def test_nothing_learnt(spark):
    docs = spark.createDataFrame([(1, "words", None, "x")], DDL)
    model = language.learn(docs)
    assert [(r.lang_pred, r.score) for r in language.predict(docs, model).collect()] == [("und", 0.0)]
    assert language.predict(docs.limit(0), model).count() == 0
    assert re.match("und", language.Scorer(model)("x")[0])


def test_numbers_are_no_letters(spark):
    model = language.learn(spark.createDataFrame([("en", "one two three"), ("fr", "un deux trois")], "lang string, text string"))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["½ ² Ⅷ ①", "Ⅷ 12 _", "a½b", "一"])], "doc_id long, text string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model).collect()}
    assert got[0] == got[1] == ("und", 0.0) and got[2][0] != "und" and got[3][0] != "und"
    assert all(language.WORD.fullmatch(c) is None for c in "½²Ⅷ①५٣_") and all(language.WORD.fullmatch(c) for c in "aßé一あب")


def test_words_are_runs_of_letters():
    from gaugework.llm.language import WORD, words_of

    odd = "".join(chr(c) for c in range(0x3000)) + "\U0001d7d8a\U00010107b十二 ½x²y Ⅷ①z İK snake_case a1b"
    for text in ("", "½ ² Ⅷ", odd, odd[::-1], "plain words, 12 of them", "x½"):
        assert words_of(text) == WORD.findall(text.lower())
