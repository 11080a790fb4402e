"""Exact dedup against SQL, and the perfect hash on its own."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from cohortwise.llm import exact, queries

FOLDER = "/root/testdata/sf0.01"


def test_query_against_sql(spark):
    df = queries.op10_exact_dedup(spark, FOLDER)
    assert differences(df, connect(FOLDER), queries.SQL["op10_exact_dedup"]) == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 20_000])
def test_hash_is_perfect_and_minimal(n):
    keys = np.random.default_rng(n).integers(0, 256, (n, 32), dtype=np.uint8)
    slots = exact.slot_of(keys, exact.displace(keys), n)
    assert sorted(slots.tolist()) == list(range(n))


def test_bytes_are_compared():
    keys = np.random.default_rng(1).integers(0, 256, (50, 32), dtype=np.uint8)
    frame = lambda k, i: pd.DataFrame({
        "shard": 0, "digest": [x.tobytes() for x in k], "win_id": i, "win_tie": i, "copies": 1})
    index = exact.build_shard(frame(keys[:30], range(30)))
    out = exact.probe_shard(frame(keys[20:], range(20, 50)), index)
    assert sorted(out.copies) == [1] * 40 + [2] * 10
    assert set(out.digest) == {k.tobytes() for k in keys}


@pytest.mark.parametrize("historical", [None, "true", "false", "doc_id % 2 = 0"])
def test_nulls_ties_and_clashing_columns(spark, historical):
    rows = [(1, "a", "x"), (4, "a", "y"), (2, "a", None), (4, "a", "y"), (7, None, "z"), (3, "", "z"),
            (None, "b", "q"), (None, "b", "q"), (None, "a", "q"), (9, "A", "q"), (10, "x" * 200_000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string").repartition(3)
    got = exact.exact_dedup(docs, historical and F.expr(historical)).collect()
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = {sha("a"): (4, 5), sha(""): (7, 2), sha("b"): (None, 2), sha("A"): (9, 1), sha("x" * 200_000): (10, 1)}
    assert len(got) == len(rows)
    for r in got:
        assert (r.keep_id, r.group_size) == want[r.text_sha256]
    for digest, (keep, _) in want.items():
        assert [r.doc_id for r in got if r.kept and r.text_sha256 == digest] == [keep]


def test_empty_table(spark):
    assert exact.exact_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
