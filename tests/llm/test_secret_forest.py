"""Secret scan: planted secrets found, words and card numbers left, labels of the caller honoured."""

import random
import re

from gaugework.llm import secret_forest as sf
from gaugework.llm.common import QUERIES

DDL = "doc_id long, text string, source string, n_chars long, print string"


def corpus():
    draw = random.Random(6)
    words = [("".join(draw.choice(["the", "an", "er", "on", "tion", "re"]) for _ in range(draw.randrange(1, 8)))) for _ in range(300)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n))

    def hexed(n):
        return "".join(draw.choice("0123456789abcdef") for _ in range(n))

    rows, secrets = [], {}
    for i in range(120):
        secret = [f'token = "{hexed(40)}"', f"password={hexed(18)}", "AKIA" + "".join(draw.choice("ABCDEFGH234567") for _ in range(16))][i % 3]
        inside = secret if i % 2 == 0 else ("4041894974608795" if i % 4 == 1 else "thetionthetionreontheer")
        if i % 2 == 0:
            secrets[i] = re.search(r"[A-Za-z0-9]{18,}", secret)[0]
        rows.append((i, f"{prose(30)} {inside} {prose(30)}", "src/a.py", 1, "clash"))
    return rows, secrets


def test_finds_secrets_only(spark):
    rows, secrets = corpus()
    docs = spark.createDataFrame(rows, DDL)
    got = sf.scan(docs).where("score >= 0.5").collect()
    assert {r.doc_id: r.finding for r in got} == secrets and len(got) == len(secrets)
    texts = {r[0]: r[1] for r in rows}
    assert all(texts[r.doc_id][r.start : r.stop] == r.finding for r in got)
    clean = sf.redact(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        want = texts[r.doc_id].replace(secrets[r.doc_id], sf.MASK) if r.doc_id in secrets else texts[r.doc_id]
        assert r.text == want and r.n_chars == (len(want) if r.doc_id in secrets else 1)


def test_labels_of_the_caller(spark):
    rows, secrets = corpus()
    docs = spark.createDataFrame(rows, DDL)
    every = sf.scan(docs).select("doc_id", "start", "finding").collect()
    labels = spark.createDataFrame([(r.doc_id, r.start, float(r.finding.isdigit())) for r in every], "doc_id long, start int, label double")
    got = sf.scan(docs, labels).where("score >= 0.5").collect()
    assert got and all(r.finding.isdigit() for r in got)


def test_awkward_rows(spark):
    key = "AKIA" + "Q2" * 8
    rows = [(1, None, None, None, None), (2, "", "x", 0, None), (None, f"é {key}", None, 5, None), (3, f"{key} " * 3000, "x", 5, None), (4, "x" * 200_000, "x", 1, None)]
    rows += [(5, f"a {key}", "x", 1, None)] * 2
    docs = spark.createDataFrame(rows, DDL)
    got = sf.scan(docs).where("score >= 0.5").collect()
    assert sorted((str(r.doc_id)) for r in got if r.doc_id != 3) == ["5", "5", "None"] and sum(r.doc_id == 3 for r in got) == 3000
    clean = {str(r.doc_id): r.text for r in sf.redact(docs).collect()}
    assert clean["None"] == "é [SECRET]" and clean["1"] is None and clean["3"] == "[SECRET] " * 3000 and len(clean["4"]) == 200_000
    assert sf.redact(docs).count() == len(rows)
    assert sf.scan(docs.limit(0)).count() == 0 and sf.redact(docs.limit(0)).count() == 0
    assert sf.scan(docs.where("doc_id = 4")).where("score >= 0.5").count() == 0  # only one label is known


def test_candidates_and_check_digit():
    assert list(sf.candidates_of("password: hunter22x end")) == [(10, 19)]
    assert sf.luhn("4532015112830366") and not sf.luhn("4532015112830367")
    block = "-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----"
    assert list(sf.candidates_of("a " + block)) == [(2, 2 + len(block))]


def test_long_values_and_encrypted_blocks():
    for text, value in (
        ('password = "Tr0ub4dor&3!xK9#pQ2z" end', "Tr0ub4dor&3!xK9#pQ2z"),
        ("DB_PASSWORD: v9$Kq!2mZx@7Lw#4R", "v9$Kq!2mZx@7Lw#4R"),
        ("token=abcdefgh12&next=AKIA" + "Q2" * 8, "abcdefgh12"),
        ("token=user!:AKIA" + "Q2" * 8, "AKIA" + "Q2" * 8),
    ):
        assert value in [text[a:b] for a, b in sf.candidates_of(text)]
    head = "-----BEGIN RSA PRIVATE KEY-----"
    for inside in ("Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00\n\nabc=", "ab/+\n" * 5000):
        block = f"{head}\n{inside}\n-----END RSA PRIVATE KEY-----"
        assert list(sf.candidates_of(f"{head} cut off {block} end")) == [(len(head) + 9, len(head) + 9 + len(block))]
        assert sf.form_label(block, "") == 1.0


def test_hot_string_does_not_fill_the_sample(spark):
    for hot in ("antidisestablishment", "thetionthetionreon", "counterrevolutionary"):
        rows = [(i, 7, 0, hot if i % 3 == 0 else f"word{i}", [1.0], float(label)) for i in range(600) for label in (0, 1)]
        known = spark.createDataFrame(rows, "doc_id long, print long, start int, finding string, features array<double>, label double")
        got = sf.labelled_sample(known, 60).collect()
        for label in (0.0, 1.0):
            own = [r.finding for r in got if r.label == label]
            assert len(own) == 60 and 5 <= own.count(hot) <= 40


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    strict = re.compile(r'AKIA[0-9A-Z]{16}|(?<=token = ")[0-9a-f]{40}(?=")|(?<=password=)[0-9a-f]{18}')
    want = {(i, m[0]) for i, t in texts.items() for m in strict.finditer(t or "")}
    got = {(r.doc_id, r.finding) for r in QUERIES["op1_secret_forest"](spark, folder).collect()}
    assert want <= got and len(got - want) <= 0.05 * len(want) + 1


def test_keys_between_letters_of_other_scripts():
    key = "AKIA" + "Q2" * 8
    for text, value in (
        (f"密钥{key}。", key),
        (f"é{key}ü", key),
        ("postgres://app:v9$Kq!2mZx@db.example.com/x", "v9$Kq!2mZx"),
        ("Passwort: v9$Kq!2m end", "v9$Kq!2m"),
        ("пароль：v9$Kq!2m", "v9$Kq!2m"),
    ):
        assert value in {text[a:b] for a, b in sf.candidates_of(text)}, text


def test_features_read_whole_values():
    corpus = sf.Corpus(["path", "some"], {("p", "a"): 5, ("a", "t"): 5, ("t", "h"): 5})
    long = "some/path/" * 40
    plain, keyed = (sf.features(long + tail, "", "", "", corpus) for tail in ("some/path/" * 8, "9fQ2xZ7bK1" * 8))
    assert plain[:1] == keyed[:1] and plain[1] < keyed[1] and plain[5] < keyed[5] and plain[6] > keyed[6] and plain[7] > keyed[7]


def test_transitions_come_from_all_words(spark):
    rows = [("aa " * 300_000 + " zyzzyva étude",)]
    corpus = sf.learn_corpus(spark.createDataFrame(rows, "text string"))
    assert "zyzzyva" not in corpus.words and ("z", "y") in corpus.log and ("é", "t") in corpus.log


def test_any_other_column_may_clash(spark):
    key = "AKIA" + "Q2" * 8
    ddl = "doc_id long, text string, _id long, _print string, _spans string, row string, a string"
    docs = spark.createDataFrame([(1, f"a {key}", 7, "p", "s", "r", "x"), (2, "nothing", 8, None, None, None, None)], ddl)
    got = sf.redact(docs)
    assert got.schema == docs.schema
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a [SECRET]", 7, "p", "s", "r", "x"), (2, "nothing", 8, None, None, None, None)]
