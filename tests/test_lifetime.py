"""Survival and lifetime value against loops over users."""

import math
import random
from datetime import datetime, timedelta

import pytest

from cohortwise.operators import lifetime

DAY0 = datetime(2024, 1, 1)
END = 60


def made_up(seed=4, users=200):
    rng = random.Random(seed)
    events = []
    for user in range(users):
        day = rng.randint(0, 50)
        stay = rng.expovariate(1 / 15)
        while day <= END:
            events.append((user, "ab"[user % 2], DAY0 + timedelta(days=day, hours=3), float(rng.randint(0, 5))))
            day += rng.randint(1, 3)
            if day > stay + 50 * (user % 3 == 0):
                break
    return events


@pytest.fixture(scope="module")
def tables(spark):
    events = made_up()
    df = spark.createDataFrame(events, "user_id long, arm string, time timestamp, value double")
    return events, df, lifetime.lifetimes(df, ["arm"], "2024-03-01", 5)


def lives(events, quiet=5):
    days = {}
    for user, arm, time, _ in events:
        days.setdefault((user, arm), []).append((time - DAY0).days)
    out = {}
    for (user, arm), d in days.items():
        left = END - max(d) > quiet
        out[user] = (arm, min(d), (max(d) if left else END) - min(d), left, END - min(d))
    return out


def test_lifetimes(tables):
    events, _, got = tables
    want = lives(events)
    assert {r.user_id: (r.arm, (r.born - DAY0.date()).days, r.age, r.left, r.seen) for r in got.collect()} == want
    assert {v[3] for v in want.values()} == {True, False}


def test_survival(tables):
    events, _, got = tables
    found = {(r.arm, r.age): r for r in lifetime.survival(got, ["arm"]).collect()}
    for arm in "ab":
        people = [v for v in lives(events).values() if v[0] == arm]
        s, spread = 1.0, 0.0
        for age in sorted({p[2] for p in people}):
            risk = sum(p[2] >= age for p in people)
            gone = sum(p[2] == age and p[3] for p in people)
            s *= 1 - gone / risk
            spread += gone / (risk * (risk - gone)) if gone < risk else 0
            row = found[arm, age]
            assert (row.at_risk, row.leavers) == (risk, gone)
            assert row.survival == pytest.approx(s) and row.se == pytest.approx(s * math.sqrt(spread))


def test_everyone_leaves(spark):
    rows = [(i, "2024-01-01", i, True, 9) for i in range(3)]
    df = spark.createDataFrame(rows, "user_id long, born string, age long, left boolean, seen long")
    assert [round(r.survival, 6) for r in lifetime.survival(df).orderBy("age").collect()] == [0.666667, 0.333333, 0.0]


def test_log_rank_is_symmetric_and_sees_a_difference(spark):
    rng = random.Random(1)
    rows = [(arm, int(rng.expovariate(1 / mean)), True, 99) for arm, mean in (("a", 10), ("b", 20), ("c", 10)) for _ in range(150)]
    df = spark.createDataFrame(rows, "arm string, age long, left boolean, seen long")
    one, two = (lifetime.log_rank(df, "arm", *pair).first() for pair in (("a", "b"), ("b", "a")))
    assert one.z == pytest.approx(-two.z) and one.p_value < 1e-4 and one.z < 0
    assert lifetime.log_rank(df, "arm", "a", "c").first().p_value > 0.01


def test_lifetime_value_weighs_for_censoring(spark, tables):
    events, df, got = tables
    found = {(r.arm, r.day): r for r in lifetime.lifetime_value(got, df, [0, 10, 30, 80], ["arm"]).collect()}
    people = lives(events)
    for arm in "ab":
        mine = {u: p for u, p in people.items() if p[0] == arm}
        seen = lambda age: sum(p[4] >= age for p in mine.values())
        for horizon in (0, 10, 30):
            total = {u: 0.0 for u in mine}
            for user, a, time, value in events:
                age = (time - DAY0).days - people[user][1]
                if a == arm and age <= horizon:
                    total[user] += value * len(mine) / seen(age)
            mean = sum(total.values()) / len(total)
            row = found[arm, horizon]
            assert row.ltv == pytest.approx(mean) and row.observed == seen(horizon) and row.users == len(mine)
            assert row.se == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in total.values()) / (len(total) - 1) / len(total)))
        assert found[arm, 80].ltv is None


def test_lifetime_value_without_keys_or_revenue(spark, tables):
    _, df, got = tables
    row = lifetime.lifetime_value(got, df.where("false"), [5]).first()
    assert row.ltv == 0 and row.users == got.count()
