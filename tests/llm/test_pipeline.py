"""Pipeline: every stage against a plain version on the previous stage's documents."""

import re

import corpus_pipeline
from gaugework.llm import secret_forest

from .test_bag_minhash import brute

DDL = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_on_the_smallest_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, strict = docs.columns, re.compile(r'AKIA[0-9A-Z]{16}|(?<=token = ")[0-9a-f]{40}(?=")|(?<=password=)[0-9a-f]{18}')
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(list(before.values()), docs.schema), small)
        rows = out.collect()
        if name == "pack_sequences":
            assert {r.doc_id for r in rows} == set(before)
            break
        assert out.columns == columns and out.schema == docs.schema
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and set(after) <= set(before)
        if name == "identify_language":
            assert all(re.search(r"[^\W\d_]", before[i].text or "") is None or i in after for i in before)
        if name == "exact_dedup":
            groups = {}
            for i, r in before.items():
                body = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
                groups[body] = min(groups.get(body, (0, i)), (-len(r.text or ""), i))
            assert set(after) == {i for _, i in groups.values()}
        if name == "near_dedup":
            assert set(after) == set(brute([(i, r.text) for i, r in before.items()]).values())
        if name == "mask_secrets":
            for i, r in before.items():
                assert not strict.search(after[i].text) and (after[i].text == r.text or secret_forest.MASK in after[i].text)
                assert after[i].n_chars == (r.n_chars if after[i].text == r.text else len(after[i].text))
        else:
            assert all(after[i] == before[i] for i in after)
        before = after


def test_run_on_awkward_documents(spark, tmp_path):
    text = "the cat and the dog sat on the mat with all the others of the house "
    rows = [(i, f"{text} number {i} {text[i:]}", "en", "s", 1) for i in range(20)]
    rows += [(30, None, "en", "s", None), (31, "", None, None, 0), (32, "123", "en", "s", 3), (33, text * 3000, None, "s", 5), (33, text * 3000, None, "s", 5), (None, text + " alone", "en", None, 2)]
    spark.createDataFrame(rows, DDL).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {30, 31, 32}.isdisjoint({r.doc_id for r in out}) and 33 in {r.doc_id for r in out}
    assert len({(r.doc_id, r.piece) for r in out}) == len(out)
    spark.createDataFrame([], DDL).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_workers_remember_one_operator_at_a_time():
    from gaugework.llm import memory, packing
    from gaugework.llm.words import HASHES

    HASHES.text("some words"), packing._ENCODERS.update({b"x": None})
    memory.only("words")
    assert len(HASHES) == 2 and not packing._ENCODERS
    memory.only("pieces")
    assert not HASHES
