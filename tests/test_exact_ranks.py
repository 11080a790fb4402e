"""The exact Mann-Whitney test against enumeration of all ways to deal the ranks."""

from itertools import combinations

import numpy as np
import pytest

from cohortwise.operators import rank_tests


def enumerated(a, b):
    pooled = np.array([*a, *b], dtype=float)
    ranks = np.array([(pooled < v).sum() + ((pooled == v).sum() + 1) / 2 for v in pooled])
    middle = len(a) * ranks.mean()
    seen = abs(ranks[:len(a)].sum() - middle)
    ways = [abs(sum(ranks[list(c)]) - middle) >= seen - 1e-9 for c in combinations(range(len(pooled)), len(a))]
    return sum(ways) / len(ways)


def test_equals_enumeration_for_small_samples(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for n in range(1, 9):
        for m in range(1, 9):
            for levels in (3, 1000):
                a, b = rng.integers(0, levels, n), rng.integers(0, levels, m)
                name = f"{n}-{m}-{levels}"
                want[name] = enumerated(a, b)
                rows += [(name, "x", float(v)) for v in a] + [(name, "y", float(v)) for v in b]
    df = spark.createDataFrame(rows, "metric string, arm string, value double")
    got = {r.metric: r for r in rank_tests.mann_whitney_exact(df, "arm", ["x", "y"]).collect()}
    assert {k: r.p_value for k, r in got.items()} == pytest.approx(want)


def test_large_samples_and_empty_arms_have_no_exact_value(spark):
    rows = [("large", "xy"[i % 2], float(i)) for i in range(60)] + [("one", "x", 1.0), ("one", "x", 2.0)]
    df = spark.createDataFrame(rows, "metric string, arm string, value double")
    got = {r.metric: r for r in rank_tests.mann_whitney_exact(df, "arm", ["x", "y"], largest=50).collect()}
    assert got["large"].p_value is None and got["one"].p_value is None
    assert (got["large"].n_0, got["large"].u) == (30, 435.0)
