"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.llm import ann, queries

FOLDER = "/root/testdata/sf0.1"


def brute(ids, x, wanted, k):
    out = {}
    for i in np.flatnonzero(np.isin(ids, wanted)):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        mine = out.setdefault(r.query_id, [])
        assert r.rank == len(mine) + 1
        mine.append((r.vec_id, r.score))
    return out


def test_recall_of_the_query(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], dtype=np.float32)
    want = brute(ids, x.astype(float), ids[ids % 20 == 0], 20)
    got = answers(queries.op6_ann(spark, FOLDER))
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.95
    at = {int(i): n for n, i in enumerate(ids)}
    for q, mine in got.items():
        assert len(mine) == 20 and q not in {v for v, _ in mine}
        assert mine == sorted(mine, key=lambda p: (-p[1], p[0]))
        for v, score in mine:
            assert score == pytest.approx(float(x[at[q]].astype(float) @ x[at[v]].astype(float)), abs=1e-12)


@pytest.mark.parametrize("block", [3, 4096])
def test_large_leaves_and_ties(spark, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 4)).astype(np.float32) * rng.uniform(0.1, 5, (60, 1)).astype(np.float32)
    x[20:50] = x[20]
    ids = np.arange(60)
    df = spark.createDataFrame([(int(i), v.tolist(), "x") for i, v in zip(ids, x)],
                               "vec_id long, embedding array<float>, score string")
    want = brute(ids, x.astype(float), ids[ids % 20 == 0], 20)
    got = answers(ann.nearest(df, F.col("vec_id") % 20 == 0))
    assert {q: [v for v, _ in m] for q, m in got.items()} == {q: [v for v, _ in m] for q, m in want.items()}


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (None, [9.0, 9.0]), (7, [1.0, 2.0, 3.0]), (8, [1.0, 1.0]), (1, [2.0, 0.0]),
            (20, None), (40, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answers(ann.nearest(df, F.col("vec_id") % 20 == 0))
    assert got == {0: [(1, 2.0), (8, 1.0), (40, 0.0)], 40: [(8, 1.0), (0, 0.0), (1, 0.0)]}


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert ann.nearest(one, F.col("vec_id") % 20 == 0).count() == 0
