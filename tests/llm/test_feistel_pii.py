"""Pseudonyms: permutations of small intervals, valid formats, linkage, and exact inversion."""

import datetime
import re

import pytest
from hypothesis import given, settings, strategies as st

from gaugework.llm import feistel_pii as pii
from gaugework.llm.common import QUERIES

F = pii.Feistel(b"key")
DDL = "doc_id long, text string, items string"
TEXT = (
    "Card 4532015112830366 and 4532 0151 1283 0366, not 4532015112830367. Mail bob.42@mail8.example.com, +1 (168) 555-5254, "
    "ssn 123-45-6789, ip 70.123.182.155 but 10.0.0.1, on 1987-02-28 and 31/12/1999, not 1987-02-30, +49 30 1234567, GB82 WEST 1234 5698 7654 32, v4.0."
)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 1024])
def test_permutations(n):
    image = [F.permute("x", i, n) for i in range(n)]
    assert sorted(image) == list(range(n))
    assert [F.permute("x", y, n, back=True) for y in image] == list(range(n))


def test_formats_stay_valid_and_linked():
    new, items = pii.replaced(F, TEXT)
    assert [k for k, *_ in items] == ["card", "card", "email", "phone", "ssn", "ipv4", "date", "date", "phone", "iban"]
    for value in ("4532015112830366", "bob.42@", "555-5254", "123-45-6789", "70.123.182.155", "1987-02-28", "31/12/1999", "1234567,", "WEST 1234"):
        assert value not in new
    for value in ("4532015112830367", "10.0.0.1", "1987-02-30", "@mail8.example.com", "+1 (", "+49 30"[:3], "v4.0."):
        assert value in new
    plain, spaced = re.findall(r"Card (\d{16}) and ([\d ]{19}),", new)[0]
    assert spaced.replace(" ", "") == plain and pii.luhn_digit(plain[:-1]) == plain[-1] and plain[0] == "4"
    datetime.date.fromisoformat(re.search(r"on (\S+) and", new)[1])
    assert pii._mod97((i := re.search(r"GB\d\d[ A-Z0-9]{23}", new)[0].replace(" ", ""))[4:] + i[:4]) == 1
    assert re.sub(r"[A-Za-z0-9]", "x", new) == re.sub(r"[A-Za-z0-9]", "x", TEXT).replace("xx.xxx.xxx.xxx", re.sub(r"\d", "x", re.search(r"ip (\S+) but", new)[1]))
    assert pii.replaced(F, new, back=True)[0] == TEXT
    assert pii.replaced(pii.Feistel(b"other"), TEXT)[0] != new


@settings(max_examples=200, deadline=None)
@given(st.dates(datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)), st.sampled_from(["%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", "plain"]))
def test_dates(day, form):
    text = f"{day.month}/{day.day}/{day.year}" if form == "plain" else day.strftime(form)
    new = pii.date(F, text)
    assert new is not None and pii.date(F, new, back=True) == text


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 899), st.integers(1, 99), st.integers(1, 9999))
def test_ssn(area, group, serial):
    text = f"{area:03d}-{group:02d}-{serial:04d}"
    new = pii.ssn(F, text)
    assert (new is None) == (area == 666)
    assert new is None or pii.ssn(F, new, back=True) == text


@pytest.mark.parametrize(
    "text, value",
    [
        ("card 4532015112830366 12/26", "4532015112830366"),
        ("4532015112830366 123", "4532015112830366"),
        ("row 2 4532 0151 1283 0366", "4532 0151 1283 0366"),
        ("12345 4532 0151 1283 0366 99", "4532 0151 1283 0366"),
        ("9 99 45 32015112830366 1", "45 32015112830366"),
        ("DE89370400440532013000 BIC COBADEFFXXX", "DE89370400440532013000"),
        ("GB82 WEST 1234 5698 7654 32 GBP 100", "GB82 WEST 1234 5698 7654 32"),
        ("AB12 GB82 WEST 1234 5698 7654 32 GBP", "GB82 WEST 1234 5698 7654 32"),
        ("9999 123-45-6789 x", "123-45-6789"),
    ],
)
def test_values_beside_other_digits_and_capitals(text, value):
    new, items = pii.replaced(F, text)
    at = text.index(value)
    assert (at, at + len(value)) in [(a, b) for _, a, b in items] and value not in new
    assert new == text.replace(value, pii.replaced(F, value)[0])


@settings(max_examples=500, deadline=None)
@given(st.from_regex(pii.PATTERN, fullmatch=True))
def test_prefilter_passes_all_that_the_pattern_matches(text):
    assert pii.MAYBE.search(text)


def test_numbers_written_in_pairs():
    for text in ("+33 1 23 45 67 89", "+45 12 34 56 78", "4 5 3 2 0 1 5 1 1 2 8 3 0 3 6 6"):
        assert pii.MAYBE.search(text)
        new = pii.replaced(F, f"call {text} now")[0]
        assert new != f"call {text} now" and pii.replaced(F, f"123 or call {text} now")[0].endswith(new.removeprefix("call "))


def test_awkward_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, TEXT, None), (3, "1 " * 50_000, "x"), (4, "4532015112830366 " * 2000, "x"), (5, TEXT, "x"), (5, TEXT, "x"), (6, "no numbers", "x")]
    docs = spark.createDataFrame(rows, DDL)
    got = pii.found_items(docs, b"key").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[1].text is None and by[2].text == "" and by[6].text == "no numbers"
    assert by[5].text == by[None].text == pii.replaced(F, TEXT)[0] and by[4].n_items == 2000 and len(set(by[4].text.split())) == 1
    assert dict(by[5].kinds) == {"card": 2, "email": 1, "phone": 2, "ssn": 1, "ipv4": 1, "date": 2, "iban": 1}
    out = pii.pseudonymised(docs, b"key")
    assert out.columns == docs.columns and {r.items for r in out.collect()} == {"x", None}
    assert pii.found_items(docs.limit(0), b"key").count() == 0
    with pytest.raises(ValueError):
        pii.Feistel(b"")


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = {r.doc_id: r for r in QUERIES["op5_feistel_pseudonyms"](spark, small).collect()}
    assert set(found) == set(texts)
    plain = re.compile(r"\S+@mail\d\.example\.com|\+1 \(\d{3}\) 555-\d{4}|\b\d{16}\b")
    for i, text in texts.items():
        for value in plain.findall(text or ""):
            if not value.isdigit() or pii.luhn_digit(value[:-1]) == value[-1]:
                assert value not in found[i].text, value
