"""Two-tier BPE against the public library, over awkward and real texts."""

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from gaugework.llm import bpe_lookup, pieces
from gaugework.llm.common import QUERIES

FILE = P.path("byte_bpe_multi_50k.tiktoken")
DDL = "doc_id long, text string, ids string"


@pytest.fixture(scope="module")
def ranks():
    with open(FILE, "rb") as f:
        return bpe_lookup.read_ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec(ranks):
    return bpe_lookup.TwoTier(ranks, P.PATTERN)


def test_perfect_hash_is_minimal(codec, ranks):
    assert sorted(codec.hash.find(k) for k in ranks) == list(range(len(ranks)))
    assert codec.hash.find(b"surely not a token of it") == -1
    assert bpe_lookup.PerfectHash([]).find(b"x") == -1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="ab  \n\t 'é漢1.<|>", max_size=80))
def test_any_text(codec, library, text):
    encoder = pieces.PieceEncoder(codec.encode_piece, most=5)
    found = encoder(text)
    assert np.frombuffer(found, "<u4").tolist() == library.encode_ordinary(text)
    assert codec.decode(found) == text.encode()


AWKWARD = [None, "", " ", "\n \n", "<|endoftext|>", "x" * 100_000, "word " * 30_000, "É" * 5000, "a  b", "a 　b", "tie tie", "tie tie"]


def test_awkward_rows(spark, library):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(AWKWARD)] + [(None, "no id", None)], DDL)
    got = {r.doc_id: r for r in bpe_lookup.encode(docs, FILE, P.PATTERN, ids=True).collect()}
    assert len(got) == len(AWKWARD) + 1
    for i, text in [*enumerate(AWKWARD), (None, "no id")]:
        ids = library.encode_ordinary(text or "")
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids) and got[i].decoded == (text or "")
    assert bpe_lookup.encode(docs.limit(0), FILE, P.PATTERN).count() == 0


def test_query_matches_library(spark, small, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op8_bpe_codec"](spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode_ordinary(texts[r.doc_id]), dtype="<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
