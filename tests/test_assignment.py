"""Stratified assignment: exact quotas, the same at any partitioning."""

from collections import Counter

import pytest

from cohortwise.operators.assignment import stratified_assignment


@pytest.fixture(scope="module")
def users(spark):
    rows = [(i, None if i % 9 == 0 else "hot" if i % 3 else f"c{i % 7}", i % 2) for i in range(6000)]
    return spark.createDataFrame(rows, "user_id long, country string, level int")


def test_quotas_and_stability(users):
    arms = {"control": 2, "test": 1}
    got = stratified_assignment(users.repartition(7), ["country", "level"], arms).collect()
    assert sorted(got) == sorted(stratified_assignment(users.coalesce(1), ["country", "level"], arms).collect())
    assert len(got) == 6000
    sizes = Counter((r.country, r.level, r.arm) for r in got)
    for country, level in {(r.country, r.level) for r in got}:
        n = sizes[country, level, "control"] + sizes[country, level, "test"]
        assert abs(sizes[country, level, "test"] - n / 3) < 1
        assert abs(sizes[country, level, "control"] - 2 * n / 3) < 1.34


def test_equal_arms_differ_by_one_at_most_and_seed_matters(users):
    arms = {"a": 1, "b": 1, "c": 1}
    one, two = ({r.user_id: r.arm for r in stratified_assignment(users, ["country"], arms, seed=s).collect()} for s in ("1", "2"))
    country = {r.user_id: r.country for r in users.collect()}
    sizes = Counter((country[u], a) for u, a in one.items())
    for c in set(country.values()):
        assert max(sizes[c, a] for a in arms) - min(sizes[c, a] for a in arms) <= 1
    assert 0.6 < sum(one[u] != two[u] for u in one) / len(one) < 0.73


def test_bad_shares(users):
    with pytest.raises(ValueError):
        stratified_assignment(users, ["country"], {"a": 0})
    assert stratified_assignment(users.where("false"), ["country"], {"a": 1}).count() == 0
