"""BPE against the library on whole texts, and exact round trips."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from cohortwise.llm import bpe, queries

FOLDER = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENCODING = bpe.encoder(FILE, public_tokenizers.PATTERN)


def test_query_against_the_library(spark):
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        ids = ENCODING.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), sha(",".join(map(str, ids)).encode()), sha((r.text or "").encode()))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op4_bpe(spark, FOLDER).collect()}
    assert got == want


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1 \n\t'sé.!𝒳　ll", max_size=80), st.integers(1, 12))
def test_cuts_are_safe(text, limit):
    assert "".join(bpe.pieces(text, limit)) == text
    assert bpe.encode(ENCODING, text, limit) == ENCODING.encode_ordinary(text)


@pytest.mark.parametrize("text", ["x" * 300_000, "a b" * 80_000, " \n" * 60_000 + "z", "don't " * 30_000])
def test_long_texts(text):
    assert bpe.encode(ENCODING, text) == ENCODING.encode_ordinary(text)


def test_rows_of_any_kind(spark):
    rows = [(1, None, 0), (2, "", 0), (None, "é x", 0), (1, "<|endoftext|>", 0), (1, "<|endoftext|>", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = bpe.encode_texts(docs, FILE, public_tokenizers.PATTERN).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded).decode()) for r in got) == sorted(
        (str(i), t or "") for i, t, _ in rows
    )
    assert all(list(r.ids) == ENCODING.encode_ordinary(bytes(r.decoded).decode()) for r in got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digest_texts(docs, FILE, public_tokenizers.PATTERN).count() == 0
