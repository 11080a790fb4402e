"""Phrase collocations against plain counting."""

import re
from collections import Counter
from decimal import Decimal

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from cohortwise.llm import collocations, queries

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, limit, least):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        mine = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                mine.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {q for p, a in candidates.items() if len(p) == 3 for q in (p[:2], p[1:]) if 100 * a >= 50 * f[q]}
        rows = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -score)
                for i, (score, a, p, left, right) in enumerate(sorted(rows)[:limit])]
    return sorted(out)


def found(df, *args):
    return sorted(map(tuple, collocations.collocations(df, *args).collect()))


@pytest.mark.parametrize("width, limit, least, chunk, held", [(4, 2000, 10, 250_000, 1_000_000), (1, 40, 3, 5000, 9000)])
def test_against_plain_counting(spark, monkeypatch, width, limit, least, chunk, held):
    monkeypatch.setattr(collocations, "WIDTH", width)
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "HELD", held)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = plain([(r.lang, r.text) for r in docs.select("lang", "text").collect()], limit, least)
    assert found(docs, limit, least) == want and len(want) > 150


def test_thresholds_fall_until_every_list_is_settled(spark, monkeypatch):
    # The pairs that score best all lie in triples, so the first threshold leaves too few.
    monkeypatch.setattr(collocations, "WIDTH", 1)
    monkeypatch.setattr(collocations, "MAP_BITS", 6)
    rows = [("x", f"q{i} r{i} s{i}. " * 3) for i in range(30)]
    rows += [("x", "the cat. the dog. the cow. a cat. a dog. a cow. " * 4), ("y", "one two. " * 5)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert found(docs, 33, 3) == plain(rows, 33, 3)
    assert {r[2] for r in found(docs, 33, 3)} >= {"q0 r0 s0", "a cat"}


def test_exact_beyond_64_bits(spark):
    big = [(3 * 10**12 + 1, 4 * 10**12 + 7, 5 * 10**12 + 3), (10**15, 10**15, 10**15), (10, 10, 10**6)]
    rows = spark.createDataFrame(big, "a long, l long, r long")
    got = rows.select("a", "l", "r", collocations.floored(collocations.score("a", "l", "r")).alias("s")).collect()
    assert all(r.s == 1_000_000 * r.a * r.a // (r.l * r.r) for r in got)
    assert not any(isinstance(r.s, Decimal) for r in got)


def test_odd_rows(spark):
    long = "Ab\tcd ef  gh, ab cd ef\x0bgh ÀB cd " * 4000
    rows = [("en", long, 1), ("en", long, 1), (None, "a b " * 20, 2), ("fr", None, 3), ("fr", "", 3), (None, None, 0),
            ("de", ".,;:!?\n", 1), ("ja", "中 文 " * 12 + "\x00 b", 1), ("es", "a a a a " * 10, 1)]
    docs = spark.createDataFrame(rows, "lang string, text string, phrase long").withColumn("n.x", F.lit(1))
    got = found(docs)
    assert got == plain([r[:2] for r in rows], 2000, 10)
    assert {r[0] for r in got} == {"en", "und", "ja", "es"}
    assert found(docs.limit(0)) == [] and found(docs.where("lang = 'fr'")) == []


def test_query_matches_sql(spark):
    assert differences(queries.op11_collocations(spark, FOLDER), connect(FOLDER), queries.SQL["op11_collocations"]) == []
