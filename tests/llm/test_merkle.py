"""The Merkle manifest against a tree built with loops."""

import hashlib
import zlib

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from cohortwise.llm import merkle, queries

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    values = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fan_out):
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(at):
            start = place // fan_out * fan_out
            paths[k].append(("".join(nodes[start:place]), "".join(nodes[place + 1:start + fan_out])))
            at[k] = place // fan_out
        nodes = [digest("".join(nodes[s:s + fan_out])) for s in range(0, len(nodes), fan_out)]
    return nodes[0], paths


def plain(rows, fan_out=8):
    by = {}
    for r in rows:
        by.setdefault(r.lang, []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    tops, paths = {}, {}
    for lang in langs:
        own = sorted(by[lang], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        tops[lang], found = tree([leaf(r, r.text) for r in own], fan_out)
        paths[lang] = list(zip(own, found))
    out = []
    root, upper = tree([tops[lang] for lang in langs], fan_out) if langs else (None, [])
    for lang, above in zip(langs, upper):
        for r, path in paths[lang]:
            text, h = r.text, None
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                text = text.translate(LOWER)
            h = leaf(r, text)
            for before, after in path + above:
                h = digest(before + h + after)
            proof = digest("".join(a + b for a, b in path + above))
            out.append((r.doc_id, leaf(r, r.text), tops[lang], root, proof, h, h == root))
    return sorted(out, key=str)


def built(docs, **options):
    return sorted(map(tuple, merkle.manifest(docs, **options).collect()), key=str)


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = built(docs)
    assert got == plain(docs.collect())
    assert 0 < sum(not r[6] for r in got) < len(got)


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65, 513])
def test_sizes_at_the_edges_of_levels(spark, size):
    rows = [(i, f"Text {i}", "en" if i % 7 else None, None, i) for i in range(size)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert built(docs.repartition(5)) == built(docs) == plain(docs.collect())


def test_binary_tree_and_own_tampering(spark):
    rows = [(i, f"Text {i}", f"l{i % 13}", "s", i) for i in range(100)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert built(docs, fan_out=2) == plain(docs.collect(), 2)
    got = built(docs, tampered=F.col("n_chars") == 5)
    assert [r[0] for r in got if not r[6]] == [5]


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "A", "en", "s", 1), (None, "A", "en", "s", 1), (2, "", "", "", 0),
            (2, "B", "", "s", None), (3, "é𝒳 A" * 100_000, "en", "s", -5), (4, "x", "Ω", "a:b", 1), (4, "x", "+", "a:b", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("h"), F.lit(2).alias("g"), F.lit(3).alias("a.b"), F.lit(4).alias("leaf"))
    assert built(docs) == plain(docs.collect())
    assert built(docs.limit(0)) == []


def test_query_matches_sql(spark):
    assert differences(queries.op12_merkle(spark, FOLDER), connect(FOLDER), queries.SQL["op12_merkle"]) == []
