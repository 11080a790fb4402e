"""Chunked timelines against plain loops, with one user holding a third of the events."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from cohortwise.operators import engagement, timeline
from cohortwise.plans import inputs


@pytest.fixture(scope="module")
def log(spark):
    rng = np.random.default_rng(11)
    n = 900
    start = datetime(2024, 1, 1)
    pdf = pd.DataFrame({
        "event_id": np.arange(n),
        "user_id": np.where(rng.random(n) < 0.34, 0, rng.integers(1, 15, n)),
        "time": [start + timedelta(minutes=int(m)) for m in rng.integers(0, 6 * 24 * 60, n)],
        "event_type": rng.choice(["view", "click", "purchase", "error"], n),
        "level": rng.integers(0, 12, n),
    })
    pdf["time"] = pdf["time"].astype("datetime64[us]")
    df = spark.createDataFrame(pdf).selectExpr(
        "event_id", "user_id", "cast(time as timestamp_ntz) as time", "event_type", "cast(level as int) as level"
    )
    return pdf.sort_values(["user_id", "time", "event_id"]), df


CHUNKINGS = [{"slices": 1}, {}, {"slices": 40}]


@pytest.mark.parametrize("chunking", CHUNKINGS)
@pytest.mark.parametrize("gap", [20, 90, 600])
def test_sessions(log, gap, chunking):
    pdf, df = log
    pause = pdf.groupby("user_id")["time"].diff()
    starts = (pause.isna() | (pause > pd.Timedelta(minutes=gap))).groupby(pdf["user_id"]).sum()
    got = engagement.user_sessions(df, gap, **chunking).groupBy("user_id").sum("sessions").toPandas()
    assert dict(zip(got["user_id"], got["sum(sessions)"])) == dict(starts)


@pytest.mark.parametrize("chunking", CHUNKINGS)
def test_rollbacks(log, chunking):
    pdf, df = log
    events = []
    for user, part in pdf.groupby("user_id"):
        levels, times = part["level"].tolist(), part["time"].tolist()
        for i in range(1, len(levels)):
            if levels[i] < levels[i - 1]:
                best = max(levels[:i])
                back = next((times[j] for j in range(i + 1, len(levels)) if levels[j] >= best), None)
                events.append((levels[i - 1] - levels[i], (back - times[i]).total_seconds() if back else None))
    depth = np.array([d for d, _ in events])
    waits = [w for _, w in events if w is not None]
    row = engagement.rollback_metrics(df, "level", **chunking).first()
    assert row.rollbacks == len(events) and row.mean_depth == pytest.approx(depth.mean())
    assert row.p95_depth == pytest.approx(np.quantile(depth, 0.95))
    assert row.recovered_share == pytest.approx(len(waits) / len(events))
    assert row.mean_seconds_to_recover == pytest.approx(np.mean(waits))
    days = pdf.groupby(["user_id", pdf["time"].dt.date]).ngroups
    net = pdf.groupby("user_id")["level"].agg(lambda s: s.iloc[-1] - s.iloc[0]).sum()
    assert row.net_progress_per_day == pytest.approx(net / days)


@pytest.mark.parametrize("chunking", CHUNKINGS)
def test_session_spans(log, chunking):
    pdf, df = log
    want = set()
    for user, part in pdf.groupby("user_id"):
        times = part["time"].tolist()
        cuts = [0] + [i for i in range(1, len(times)) if times[i] - times[i - 1] > pd.Timedelta(minutes=90)]
        for a, b in zip(cuts, cuts[1:] + [len(times)]):
            want.add((user, times[a].to_pydatetime(), times[b - 1].to_pydatetime()))
    got = [(r.user_id, r.start, r.end) for r in engagement.session_spans(df, 90, **chunking).collect()]
    assert len(got) == len(want) and set(got) == want


def test_all_events_of_a_user_in_one_hour(spark):
    df = spark.range(5000).selectExpr(
        "id as event_id", "if(id % 5 = 0, id, 7) as user_id", "'view' as event_type",
        "cast(timestamp_micros(1704067200000000 + id * 700000) as timestamp_ntz) as time",
    )
    got = {r.user_id: (r.sessions, r.events) for r in engagement.user_sessions(df, 30, slices=16).collect()}
    assert got[7] == (1, 4000) and len(got) == 1001


def test_slices_are_bounded(spark):
    df = spark.range(5000).selectExpr("7 as user_id", "timestamp_micros(id * id) as time")
    sizes = [r["count"] for r in timeline.with_slice(df, "time", 16).groupBy(timeline.CHUNK).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 5000 / 16


def test_one_scan_for_each_pass(spark):
    events = inputs.activity(spark, "/root/testdata/sf0.01")
    df = engagement.user_sessions(events, 180)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") <= 2


def test_stickiness(log):
    pdf, df = log
    seen = pdf.assign(day=pdf["time"].dt.date)[["user_id", "day"]].drop_duplicates()
    got = {r.date: (r.dau, r.mau) for r in engagement.stickiness(df, 3).collect()}
    for day in sorted(seen["day"].unique()):
        window = seen[(seen["day"] <= day) & (seen["day"] > day - timedelta(days=3))]
        assert got[day] == ((seen["day"] == day).sum(), window["user_id"].nunique())


FUNNEL_ROWS = """select u as user_id, cast(t as timestamp_ntz) as time, e as event_type from values
    (1L, '2024-01-01 00:00:00', 'view'), (1L, '2024-01-01 01:00:00', 'click'), (1L, '2024-01-01 02:00:00', 'purchase'),
    (2L, '2024-01-01 00:00:00', 'click'), (2L, '2024-01-01 01:00:00', 'view'),
    (3L, '2024-01-01 00:00:00', 'view'), (3L, '2024-01-01 01:00:00', 'purchase'),
    (4L, '2024-01-01 00:00:00', 'click'), (4L, '2024-01-01 01:00:00', 'view'), (4L, '2024-01-01 02:00:00', 'click'),
    (4L, '2024-01-01 03:00:00', 'purchase'),
    (5L, '2024-01-01 00:00:00', 'purchase'), (5L, '2024-01-01 00:00:00', 'click'), (5L, '2024-01-01 00:00:00', 'view')
    as t(u, t, e)"""


@pytest.mark.parametrize("slices", [1, 3, 20])
def test_funnel_follows_the_order(spark, slices):
    got = engagement.funnel(spark.sql(FUNNEL_ROWS), ("view", "click", "purchase"), slices).collect()
    assert [(r.step, r.users, r.dropped) for r in got] == [(1, 5, 0), (2, 3, 2), (3, 3, 0)]


@pytest.mark.parametrize("slices", [1, 4, 30])
def test_funnel_and_time_to_step_against_a_walk(log, slices):
    pdf, df = log
    steps = ["view", "click", "purchase"]
    reached, waits, tries = [0, 0, 0], [], []
    for _, part in pdf.groupby("user_id"):
        events = list(zip(part["time"], part["event_type"]))
        at = min(t for t, e in events)
        for i, step in enumerate(steps):
            later = [t for t, e in events if e == step and t >= at]
            if not later:
                break
            at = min(later)
            reached[i] += 1
        begin = min((t for t, e in events if e == "view"), default=None)
        goals = [t for t, e in events if begin is not None and e == "purchase" and t >= begin]
        if goals:
            waits.append((min(goals) - begin).total_seconds())
            tries.append(sum(e == "click" and t <= min(goals) for t, e in events))
    assert [r.users for r in engagement.funnel(df, steps, slices).collect()] == reached
    row = engagement.time_to_step(df, *steps, slices=slices).first()
    assert (row.users, row.median_attempts, row.median_seconds) == (
        len(waits), np.median(tries), pytest.approx(np.median(waits)))
    assert (row.mean_seconds, row.mean_attempts) == (pytest.approx(np.mean(waits)), pytest.approx(np.mean(tries)))


def test_time_to_step_counts_attempts_up_to_the_goal(spark):
    df = spark.sql("""select u as user_id, cast(t as timestamp_ntz) as time, e as event_type from values
        (1L, '2024-01-01 00:00:00', 'start'), (1L, '2024-01-01 00:10:00', 'try'), (1L, '2024-01-01 02:10:00', 'try'),
        (1L, '2024-01-01 02:20:00', 'goal'), (1L, '2024-01-01 02:30:00', 'try'), (1L, '2024-01-01 05:00:00', 'try'),
        (2L, '2024-01-01 00:00:00', 'start'), (2L, '2024-01-01 00:00:10', 'goal'),
        (3L, '2024-01-01 00:00:00', 'start'),
        (4L, '2024-01-01 00:00:00', 'goal'), (4L, '2024-01-01 00:01:00', 'start') as t(u, t, e)""")
    row = engagement.time_to_step(df, "start", "try", "goal").first()
    assert (row.users, row.mean_attempts, row.median_attempts) == (2, 1.0, 1.0)
    assert row.mean_seconds == pytest.approx((8400 + 10) / 2)


def test_churn_after(spark):
    df = spark.sql("""select u as user_id, cast(t as timestamp_ntz) as time, e as event_type from values
        (1L, '2024-01-02 00:00:00', 'join'), (1L, '2024-01-05 00:00:00', 'visit'),
        (2L, '2024-01-02 00:00:00', 'join'), (3L, '2024-01-05 00:00:00', 'join') as t(u, t, e)""")
    got = engagement.churn_after(df, "join", "2024-01-01", "2024-01-03", (1, 2)).collect()
    assert [(r.days, r.participants, r.churned) for r in got] == [(1, 2, 2), (2, 2, 1)]
