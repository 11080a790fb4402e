"""The daily mart in updates equals the mart of all days."""

import random
from datetime import datetime, timedelta

import pytest

from cohortwise.operators import incremental
from cohortwise.operators.marts import daily_mart


@pytest.fixture(scope="module")
def actions(spark):
    rng = random.Random(3)
    rows = [
        (datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 12 * 1440 - 1)), rng.randint(1, 30),
         rng.choice([None, *(f"p{i}" for i in range(60))]), rng.choice(["like", "view"]))
        for _ in range(900)
    ]
    df = spark.createDataFrame(rows, "time timestamp, user_id long, post_id string, action string")
    return df.where("to_date(time) <> '2024-01-06'").selectExpr("cast(time as timestamp_ntz) as time", "user_id", "post_id", "action")


def update(actions, folder, *periods):
    for start, end in periods:
        incremental.update_daily_mart(actions, f"{folder}/mart", f"{folder}/state", f"2024-01-{start:02}", f"2024-01-{end:02}")


def rows(spark, folder):
    return sorted(map(str, spark.read.parquet(f"{folder}/mart").select(
        "date", "dau", "likes", "views", "ctr", "unique_viewed_posts", "new_posts"
    ).collect()))


def test_day_by_day_equals_all_days(spark, actions, tmp_path):
    update(actions, tmp_path, *[(d, d) for d in range(1, 13)])
    want = sorted(map(str, daily_mart(actions).collect()))
    assert rows(spark, tmp_path) == want and len(want) == 11


def test_replays_change_nothing(spark, actions, tmp_path):
    update(actions, tmp_path, (1, 5), (6, 12))
    before = rows(spark, tmp_path)
    state = sorted(map(str, spark.read.parquet(f"{tmp_path}/state").collect()))
    update(actions, tmp_path, (6, 12))
    assert rows(spark, tmp_path) == before
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/state").collect())) == state
    update(actions, tmp_path, (1, 12))
    assert rows(spark, tmp_path) == before
    with pytest.raises(ValueError, match="days after"):
        update(actions, tmp_path, (1, 1))


def test_late_actions_move_first_days(spark, actions, tmp_path):
    few = actions.where("not (post_id = 'p7' and time < '2024-01-05')")
    update(few, tmp_path, (1, 12))
    update(actions, tmp_path, (1, 12))
    assert rows(spark, tmp_path) == sorted(map(str, daily_mart(actions).collect()))
