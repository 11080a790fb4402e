"""Tail index and means without the largest payers."""

import math
import random

import pytest

from cohortwise.operators import tails


def test_against_sorted_lists(spark):
    rng = random.Random(2)
    rows = [("ab"[i % 2], rng.paretovariate(2) * 100 if i % 3 else 0.0) for i in range(4000)] + [("a", None), (None, 5.0), ("c", 7.0)]
    df = spark.createDataFrame(rows, "arm string, revenue double")
    got = {(r.arm, r.removed): r for r in tails.tail_check(df, "arm", "revenue", (0, 1, 10, 100)).collect()}
    for arm in "ab":
        values = sorted((v or 0.0 for a, v in rows if a == arm), reverse=True)
        for k in (0, 1, 10, 100):
            row = got[arm, k]
            assert row.users == len(values)
            assert row.mean_left == pytest.approx(sum(values[k:]) / (len(values) - k))
            assert row.removed_share == pytest.approx(sum(values[:k]) / sum(values))
        hill = 100 / sum(math.log(v / values[100]) for v in values[:100])
        assert got[arm, 100].hill_index == pytest.approx(hill) and 1.5 < hill < 2.7
    assert got["c", 1].removed_share == 1 and got["c", 1].hill_index is None and got["c", 10].mean_left is None
    effect = {r.removed: r for r in tails.tail_effect(tails.tail_check(df, "arm", "revenue", (0, 10)), "arm", "a", "b").collect()}
    assert effect[10].effect == pytest.approx(got["b", 10].mean_left - got["a", 10].mean_left)
