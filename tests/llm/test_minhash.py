"""MinHash near-dedup against all pairs."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from cohortwise.llm import minhash, queries

FOLDER = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain(texts, size=2):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    index, up = {}, {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            index.setdefault(g, []).append(i)

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, s in sets.items():
        for j, common in Counter(j for g in s for j in index[g] if j > i).items():
            if 100 * common >= 80 * (len(s) + len(sets[j]) - common):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return sorted((i, len(s), top(i), top(i) == i) for i, s in sets.items())


def found(docs, **options):
    return sorted(tuple(r)[:4] for r in minhash.near_dedup(docs, **options).collect())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    want = plain({r.doc_id: r.text for r in docs.collect()})
    assert found(docs) == want and sum(not r[3] for r in want) > 50


@pytest.mark.parametrize("block, part", [(256, 2048), (16, 10)])
def test_one_family_of_near_copies(spark, monkeypatch, block, part):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "PART", part)
    rng = random.Random(1)
    texts = {}
    for k in range(500):
        words = [f"w{i}" for i in range(150)]
        for _ in range(rng.randint(0, 14)):
            words[rng.randrange(150)] = f"x{rng.randrange(40)}"
        texts[k] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = found(docs)
    assert got == plain(texts) and 20 < sum(r[3] for r in got) < 400


def test_similarity_on_both_sides(spark):
    rng = random.Random(8)
    texts = {}
    for base in range(40):
        words = [f"b{base}w{i}" for i in range(rng.choice((3, 10, 12, 60, 200, 900)))]
        for _ in range(8):
            changed = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 12))):
                changed[rng.randrange(len(words))] = f"x{rng.random()}"
            texts[len(texts)] = " ".join(changed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert found(docs) == plain(texts)
    assert found(docs, shingle=5) == plain(texts, 5)


def test_posterior_bounds():
    rng = np.random.default_rng(2)
    for h, least in minhash.least_matches(0.8, 1e-3):
        draws = rng.beta(least + 1, h - least + 1, 400_000)
        assert (draws >= 0.8).mean() >= 5e-4
        draws = rng.beta(least, h - least + 2, 400_000)
        assert (draws >= 0.8).mean() < 2e-3
    x = rng.integers(0, 2**32, (3, minhash.HASHES), dtype=np.uint32)
    y = x.copy()
    y[1, ::4] += 1  # three quarters agree
    y[2] += 1
    assert minhash.matched(x, y, minhash.least_matches(0.8, 1e-6)).tolist() == [160, 120, -1]


def test_no_link_is_ruled_out_by_size_or_parity():
    a, b = minhash.multipliers()
    rng = np.random.default_rng(4)
    ruled_out = 0
    for n in (5, 40, 150, 400, 3000):
        for share in (0.5, 0.7, 0.76, 0.8, 0.82, 0.9):
            pool = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
            common = round(2 * n * share / (1 + share))
            x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:2 * n - common]]))
            both = [np.frombuffer(minhash.sketch(g, a, b), dtype=np.uint32)[None] for g in (x, y)]
            every = [(h, 0) for h in range(32, 161, 32)]
            got = minhash.compared(*both, every, 0.8)[0]
            if common >= 0.8 * (len(x) + len(y) - common):
                assert got >= 0
            ruled_out += got < 0
    assert ruled_out >= 8


@pytest.mark.parametrize("size", [1, 2, 3, 7, 40])
def test_members_alone_in_a_bucket_are_left_out(size):
    rng = random.Random(size)
    rows = sorted((rng.randrange(25), i, 100 + i, rng.choice((8, 10, 20)), i % 4) for i in range(40))
    schema = pa.schema([(c, pa.int64()) for c in ("key", "order", "id", "n", "band")])
    batches = [pa.RecordBatch.from_pylist(
        [dict(zip(schema.names, r)) for r in rows[at:at + size]], schema=schema
    ) for at in range(0, len(rows), size)]
    got = [tuple(r.values()) for b in minhash.meetings(iter(batches), 0.8) for r in b.to_pylist()]
    wanted = []
    for key in sorted({r[0] for r in rows}):
        bucket = [r for r in rows if r[0] == key]
        first = bucket[0]
        for place, (_, _, id_, n, band) in enumerate(bucket if len(bucket) > 1 else []):
            near = place and min(n, first[3]) >= 0.8 * max(n, first[3])
            wanted.append((key, id_, band, first[2] if near else None))
    assert got == wanted


def test_signatures_estimate_similarity():
    a, b = minhash.multipliers()
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    x, y = minhash.signature(pool[:2000], a, b), minhash.signature(pool[500:2500], a, b)
    assert abs((x == y).mean() - 0.6) < 0.15


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, long), (7, long + " end"),
            (8, "a b c d e f"), (8, "a b c d e f"), (9, "É b"), (10, "é b"), (None, "a b c d e f"), (None, "nothing else"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit(1).alias(c) for c in ("tie", "n", "kept", "h1", "a.b")]
    )
    got = minhash.near_dedup(docs).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert by[1, 0] == 1 and by[2, 0] == 2 and by[3, 0] == 3 and by[5, 1] == 4 and by[6, 1] == 6
    assert by[7, 59_999] == by[7, 60_000] == 7 and by[None, 5] == 8 and by[9, 1] == 9 and by[10, 1] == 10
    assert sorted(r.kept for r in got if r.component_id == 8) == [False, False, True]
    assert [r.kept for r in got if r.doc_id == 7].count(True) == 1
    assert minhash.near_dedup(docs.limit(0)).count() == 0


def test_query_matches_sql(spark):
    assert differences(queries.op13_minhash(spark, FOLDER), connect(FOLDER), queries.SQL["op13_minhash"]) == []
