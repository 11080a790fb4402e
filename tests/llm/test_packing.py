"""Packing: every id in exactly one piece, gapless windows, little padding."""

import zlib
from array import array
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cohortwise.llm import packing, queries

FOLDER = "/root/testdata/sf0.01"
FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "a  b", "a\n b", "x\n \nfoo", "a   b", "foo \n bar", "a ", "  lead", "", " ", " \n",
    "<|endoftext|> a\n <|endoftext|> b", "it's 's 'S don't  x 's", "a\tb \tc", "nul \0 x \0\0y",
    "\n\n a\n\n b", "é ü 漢字   x　 y", "word " * 3000, "x" * 20_000 + " y",
]


def check(rows, texts, window=1024):
    """``texts``: doc_id to text; ids must be unique here."""
    tokenizer = Tokenizer.from_file(FILE)
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = np.array(
            tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids + [0], dtype="<u4"
        )
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    used = []
    for own in windows.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
        used.append(at)
    return used


def test_query_packs_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    used = check(queries.op1_packing(spark, FOLDER).collect(), texts)
    assert sum(1024 - u for u in used) < 1024 * 8


def test_odd_texts(spark):
    texts = dict(enumerate([None, *ODD]))
    docs = spark.createDataFrame(
        [(i, t, 7) for i, t in texts.items()], "doc_id long, text string, length int"
    )
    check(packing.pack(docs, FILE).collect(), texts)


def test_repeated_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    rows = packing.pack(docs, FILE).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "None"]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), FILE).count() == 0


@pytest.mark.parametrize("window", [8, 50, 1024])
def test_level_choice_is_the_least_sum_of_squares(window):
    rng = np.random.default_rng(1)
    packer = packing.SumOfSquares(window)
    filled = {}
    for size in rng.integers(1, window, 400):
        before = packer.levels.copy()
        options = {}
        for level in [0, *np.flatnonzero(before[1:]) + 1]:
            if level + size <= window:
                after = before.copy()
                after[level] -= level > 0
                after[level + size] += level + size < window
                options[int(level)] = int((after[:window] ** 2).sum())
        number, level = packer.place(int(size))
        assert options[level] == min(options.values())
        assert filled.get(number, 0) == level
        filled[number] = level + int(size)
        counts = np.bincount([f for f in filled.values() if f < window], minlength=window + 1)
        assert (counts == packer.levels).all()


def test_both_ways_give_the_same_ids(spark):
    encoder = packing.Encoder(FILE)
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    single = ["".join(chr(c) for c in (k, k, 32, k, 97, k, 49, k, 32, 32, k)) for k in range(0x250)]
    for text in texts + single + [t for t in ODD if encoder.plain(t)]:
        assert encoder.encode(text) == array("I", encoder.whole(text)).tobytes()
    assert not encoder.plain(ODD[10])
