"""Word-sequence dedup against a dictionary of all windows; the index against plain search."""

import hashlib
import re

import numpy as np
import pytest

from cohortwise.llm import fm_index, queries, repeats, substring

FOLDER = "/root/testdata/sf0.01"


def plain(texts, span=50):
    rank = lambda i: repeats.NO_ID if i is None else i
    data = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts]
    first = {}
    for i, words in data:
        for at in range(len(words) - span + 1):
            w = tuple(words[at:at + span])
            first[w] = min(first.get(w, repeats.NO_ID), rank(i))
    out = []
    for i, words in data:
        gone = [False] * len(words)
        for at in range(len(words) - span + 1):
            if first[tuple(words[at:at + span])] < rank(i):
                gone[at:at + span] = [True] * span
        left = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows(df):
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_query_against_all_windows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    got = rows(queries.op8_fm_dedup(spark, FOLDER))
    assert got == plain([(r.doc_id, r.text) for r in docs])
    assert sum(r[2] for r in got) > 5_000


def odd_texts():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdéf"), rng.integers(1, 4)))
    passage = [word() for _ in range(90)]
    texts = [(i, " ".join([word() for _ in range(20)] + passage[i:i + 45 + i]
                          + [word() for _ in range(15)])) for i in range(14)]
    texts += [(20, None), (21, ""), (22, "a " * 49), (23, "a " * 50), (24, "a " * 300), (25, "a\tb\x0b" * 60),
              (3, texts[7][1]), (3, texts[7][1]), (None, texts[2][1]), (None, " ".join(passage)),
              (40, "\n".join(passage * 3)), (42, " ".join(passage * 2)), (43, "x\x00y " * 120)]
    return texts


def test_odd_documents(spark):
    texts = odd_texts()
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, first int")
    assert rows(substring.word_dedup(docs)) == plain(texts)


@pytest.mark.parametrize("module, name, value", [
    (repeats, "CHUNK", 120), (repeats, "HOT", 1), (repeats, "HELD", 5), (repeats, "LOCAL_RUNS", 3),
    (substring, "HOT", 0), (substring, "GROUP", 1), (substring, "SHARD_WORDS", 10),
])
def test_limits_change_nothing(spark, monkeypatch, module, name, value):
    monkeypatch.setattr(module, name, value)
    texts = odd_texts()
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert rows(substring.word_dedup(docs)) == plain(texts)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring.word_dedup(docs).count() == 0


def test_backward_search_finds_every_occurrence():
    rng = np.random.default_rng(6)
    text = np.append(rng.integers(1, 5, 400), 0)
    index = fm_index.FMIndex(text)
    suffixes = [tuple(text[i:]) for i in index.places]
    assert suffixes == sorted(suffixes)
    for length in (1, 3, 5):
        ends = np.arange(length, len(text))
        pattern, first, last = fm_index.repeated(index, text, ends, length)
        for p, a, b in zip(pattern, first, last):
            wanted = tuple(text[ends[p] - length:ends[p]])
            places = [i for i in range(len(text)) if tuple(text[i:i + length]) == wanted]
            assert sorted(index.places[a:b]) == places
        assert len(pattern) == sum(
            len([i for i in range(len(text)) if tuple(text[i:i + length]) == tuple(text[e - length:e])]) > 1
            for e in ends
        )
