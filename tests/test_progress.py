"""Retry chains and spending after rollbacks against a walk of every user."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import progress

START = datetime(2024, 1, 1)


def made_up(spark, seed, users=25, hot=600):
    rng = random.Random(seed)
    rows, number = [], 0
    for user in range(users):
        for _ in range(hot if user == 0 else rng.randint(1, 40)):
            number += 1
            rows.append((user, START + timedelta(minutes=rng.randint(0, 20_000)), number, rng.choice([*range(12), None])))
    return rows, spark.createDataFrame(rows, "user_id long, time timestamp, event_id long, level int")


def walk(rows, goal):
    users = {}
    for user, time, event, level in rows:
        if level is not None:
            users.setdefault(user, []).append((time, event, level))
    out = dict.fromkeys(("users", *progress.COUNTERS, "stuck_users", "longest_chain", "attempts", "won_tries", "gained"), 0)
    for events in users.values():
        events.sort()
        out["users"] += 1
        out["attempts"] += len(events) - 1
        out["gained"] += max(e[2] for e in events) - events[0][2]
        best = last = None
        open_ = waiting = False
        tries = 0
        for _, _, level in events:
            drop = last is not None and level < last
            peak = best is None or level >= best
            if open_:
                out["retried"] += tries == 0
                tries += 1
                out["longest_chain"] = max(out["longest_chain"], tries)
                if peak:
                    open_ = False
                    out["recovered"] += 1
                    out["won_tries"] += tries
                    waiting = level < goal
                    out["completed"] += not waiting
            elif drop:
                open_, waiting, tries = True, False, 0
                out["episodes"] += 1
            elif waiting and level >= goal:
                waiting = False
                out["completed"] += 1
            best, last = level if best is None else max(best, level), level
        out["stuck_users"] += open_
    return out


@pytest.mark.parametrize("slices", [1, 7, 64])
@pytest.mark.parametrize("goal", [9, None])
def test_chains_equal_a_walk(spark, slices, goal):
    rows, events = made_up(spark, 3)
    want = walk(rows, 11 if goal is None else goal)
    got = progress.retry_chains(events, "level", goal, slices).first().asDict()
    for name in ("users", *progress.COUNTERS, "stuck_users", "longest_chain", "attempts"):
        assert got[name] == want[name], name
    assert got["attempts_to_recover"] == pytest.approx(want["won_tries"] / want["recovered"])
    assert got["attempts_per_level"] == pytest.approx(want["attempts"] / want["gained"])
    assert 0 < want["completed"] < want["recovered"] < want["retried"]


def test_chains_without_events(spark):
    _, events = made_up(spark, 1, 3, 5)
    got = progress.retry_chains(events.where("false"), "level", 5).first()
    assert got.users == 0 and got.episodes == 0 and got.retry_share is None


def test_spend_of_a_hot_user_against_all_pairs(spark):
    rng = random.Random(9)
    moment = lambda: START + timedelta(minutes=rng.randint(-5000, 5000) * 30)
    marks = [(i, 0 if i < 400 else rng.randint(1, 9), moment()) for i in range(600)] + [(600, None, START), (601, 1, None)]
    paid = [(0 if rng.random() < 0.5 else rng.randint(1, 9), moment(), float(rng.randint(1, 50))) for _ in range(900)] + [(None, START, 1.0)]
    got = progress.spend_within(
        spark.createDataFrame(marks, "mark_id long, user_id long, time timestamp"),
        spark.createDataFrame(paid, "user_id long, time timestamp, value double"), 24,
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
    want = {}
    for i, user, at in marks[:600]:
        near = [v for u, t, v in paid if u == user and at < t <= at + timedelta(hours=24)]
        want[i] = (sum(near), len(near))
    assert {r.mark_id: (r.spent, r.purchases) for r in got.collect()} == want
    assert sum(n for _, n in want.values()) > 500


def test_spend_after_rollback_shares(spark):
    rows = [(1, START + timedelta(hours=h), h, v) for h, v in enumerate([1, 5, 2, 5, 3])] + [(2, START, 100, 4), (2, START + timedelta(hours=1), 101, 1)]
    events = spark.createDataFrame(rows, "user_id long, time timestamp, event_id long, level int")
    spend = spark.createDataFrame([(1, START + timedelta(hours=3), 7.0), (2, START - timedelta(hours=1), 9.0)], "user_id long, time timestamp, value double")
    got = progress.spend_after_rollback(events, "level", spend, 2).first()
    assert (got.rollbacks, got.paying_rollbacks, got.spent_per_rollback) == (3, 1, pytest.approx(7 / 3))
    assert got.recovered_share_paying == 1 and got.recovered_share_others == 0
    none = progress.spend_after_rollback(events, "level", spend.where(F.lit(False)), 2).first()
    assert none.paying_rollbacks == 0 and none.recovered_share_paying is None
