"""Packing: ids against the library, gapless sequences, and few of them."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from gaugework.llm import packing
from gaugework.llm.common import QUERIES

FILE = P.path("byte_bpe_50k.json")
DDL = "doc_id long, text string, length string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)  # as it is: the string of an added token in a text is that token


def check(rows, texts, tokenizer, capacity):
    """Every document is there once, cut as stated; sequences have no gaps. Returns sequences and tokens."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for doc, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(by_doc[doc], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence), total


def test_query(spark, small, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    n, total = check(QUERIES["op2_best_fit_packing"](spark, small).collect(), texts, tokenizer, 1024)
    assert n <= 1.05 * -(-total // 1024) + 1


def test_strings_of_added_tokens(spark, tokenizer):
    texts = dict(enumerate(["one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|>b", " <|endoftext|>  x ", "<|endoftext|", "one two", "<|endoftext |>"]))
    rows = packing.token_pieces(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), FILE, 2, ids=True).collect()
    assert {r.doc_id: list(r.ids) for r in rows} == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in texts.items()}
    assert len({r.doc_id: r.ids for r in rows}[0]) == 5


def test_awkward_rows(spark, tokenizer):
    texts = {1: None, 2: "", 3: "tie", 4: "tie", 5: "long text, " * 9000, 6: "x" * 50_000, None: "no id", 7: "<|endoftext|> é"}
    docs = spark.createDataFrame([(i, t, "clash") for i, t in texts.items()], DDL)
    placed = packing.pack(docs, FILE, 2, capacity=64, ids=True)
    check(placed.collect(), texts, tokenizer, 64)
    joined = packing.sequences(placed).collect()
    assert Counter(i for r in joined for i in r.ids) == Counter(
        i for t in texts.values() for i in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
    )
    assert packing.pack(docs.limit(0), FILE, 2).count() == 0
    again = packing.pack(docs.where("doc_id = 3").union(docs.where("doc_id = 3")), FILE, 2).collect()
    assert len(again) == 2 and len({(r.sequence_id, r.offset) for r in again}) == 2


def test_common_lengths_are_ranked_in_parts(spark):
    pieces = spark.range(2000).selectExpr("id as doc_id", "0 as piece", "0L as start", "if(id % 3 = 0, 5L, 1 + id % 10) as length")
    rows = packing.place(pieces, 10, rows_per_part=50).collect()
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    for members in spans.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 10
    assert len(rows) == 2000 and len(spans) <= 1.02 * sum(r.length for r in rows) / 10


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_and_few_sequences(seed):
    draw = random.Random(seed)
    histogram = Counter(min(1024, int(draw.paretovariate(0.7) * 20)) for _ in range(20_000))
    plan = packing.pack_counts(histogram, 1024)
    assert Counter({x: n for x, n in histogram.items()}) == sum((Counter({x: kind.count(x) * n for x in kind}) for kind, n in plan), Counter())
    assert all(sum(kind) <= 1024 for kind, _ in plan)
    least = -(-sum(x * n for x, n in histogram.items()) // 1024)
    assert sum(n for _, n in plan) <= 1.01 * least + 1
    assert packing.pack_counts({}, 1024) == []


def test_each_distinct_piece_is_looked_up_once(tokenizer):
    """Texts of the same pieces over and over; ids are those of the library, also for blanks of all kinds and when memory is short."""
    with open(FILE) as f:
        encoder = packing.TextEncoder(f.read())
    encoder.pieces.most = 40
    looked_up = []

    class Counted(type(encoder.pieces.later)):
        def __getitem__(self, piece):
            looked_up.append(piece)
            return super().__getitem__(piece)

    encoder.pieces.later = Counted(encoder.pieces.later.encode, 40)
    draw = random.Random(2)
    odd = ["", " ", "a", " a", "a ", "a  b", "a\n b", "a  b", "é  x", "x\ty z", "last\n", "<|endoftext|> a b"]
    texts = odd + [" ".join(f"w{draw.randrange(60)}" for _ in range(200)) for _ in range(50)]
    found = [list(np.frombuffer(x, dtype="<u4")) for x in encoder.batch(texts)]
    assert found == [tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
    assert len(looked_up) < 200
