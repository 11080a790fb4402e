import calendar
from datetime import date

import pytest

from cohortwise.operators.retention import (
    calculate_retention, retention_checks, retention_matrix, weighted_retention,
)


def unix(day: str) -> int:
    return calendar.timegm(date.fromisoformat(day).timetuple())


@pytest.fixture
def players(spark):
    reg = [("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 3)]
    auth = [
        ("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 1), ("2024-01-01", 2),
        ("2024-01-03", 2), ("2024-01-02", 3), ("2024-01-03", 3),
    ]
    return (
        spark.createDataFrame([(unix(d), u) for d, u in reg], "reg_ts long, uid long"),
        spark.createDataFrame([(unix(d), u) for d, u in auth], "auth_ts long, uid long"),
    )


def cells(df):
    return {(str(r.cohort_date), r.day): r.retention for r in df.collect()}


def test_values_in_percent_and_mask(players):
    got = cells(calculate_retention(*players, max_days=2, as_percent=True))
    assert [got["2024-01-01", d] for d in range(3)] == [100.0, 50.0, 100.0]
    assert [got["2024-01-02", d] for d in range(3)] == [100.0, 100.0, None]


def test_unmasked_cells_are_zero(players):
    got = cells(calculate_retention(*players, max_days=2, mask_incomplete=False))
    assert got["2024-01-02", 2] == 0.0


def test_cohort_filter_keeps_the_observation_end_of_all_users(players):
    got = calculate_retention(*players, "2024-01-02", "2024-01-02", max_days=1)
    assert set(cells(got)) == {("2024-01-02", 0), ("2024-01-02", 1)}
    early = calculate_retention(*players, "2024-01-01", "2024-01-01", max_days=4).collect()
    assert {str(r.observation_end) for r in early} == {"2024-01-03"}
    assert {r.day for r in early if r.retention is None} == {3, 4}


def test_two_user_smoke(spark):
    reg = spark.createDataFrame([(1704067200, 1), (1704067200, 2)], "reg_ts long, uid long")
    auth = spark.createDataFrame(
        [(1704067200, 1), (1704153600, 1), (1704067200, 2)], "auth_ts long, uid long"
    )
    long = calculate_retention(reg, auth, max_days=1, as_percent=True)
    assert [cells(long)["2024-01-01", d] for d in (0, 1)] == [100.0, 50.0]
    wide = retention_matrix(long, 1).first()
    assert (wide.d0, wide.d1, wide.cohort_size) == (100.0, 50.0, 2)


def test_day_does_not_depend_on_the_session_time_zone(spark, players):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        got = cells(calculate_retention(*players, max_days=1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["2024-01-01", 1] == 0.5


def test_repeated_registration_is_rejected(players):
    reg, auth = players
    twice = reg.unionByName(reg.limit(1))
    with pytest.raises(ValueError, match="exactly once"):
        calculate_retention(twice, auth, check_now=True)
    with pytest.raises(Exception, match="exactly once"):
        calculate_retention(twice, auth).collect()


@pytest.mark.parametrize("row, message", [((1704067200, None), "null"), (("soon", 9), "non-numeric")])
def test_unusable_rows_are_rejected(spark, players, row, message):
    reg = players[0].selectExpr("cast(reg_ts as string) reg_ts", "uid")
    auth = players[1].selectExpr("cast(auth_ts as string) auth_ts", "uid")
    extra = spark.createDataFrame([(str(row[0]), row[1])], "ts string, uid long")
    for a, b in (
        (reg.union(extra), auth), (reg, auth.union(extra)),
    ):
        with pytest.raises(ValueError, match=message):
            calculate_retention(a, b, check_now=True)
        with pytest.raises(Exception, match=message):
            calculate_retention(a, b).collect()


def test_argument_and_column_checks(players):
    reg, auth = players
    for days in (-1, 1.5, "3", True):
        with pytest.raises(ValueError, match="max_days"):
            calculate_retention(reg, auth, max_days=days)
    with pytest.raises(ValueError, match="reg_ts"):
        calculate_retention(reg.drop("reg_ts"), auth)
    with pytest.raises(ValueError, match="no registration cohort"):
        calculate_retention(reg, auth, "2030-01-01", check_now=True)


def test_weighted_by_cohort_size(players):
    got = {r.day: r for r in weighted_retention(calculate_retention(*players, max_days=2)).collect()}
    assert got[1].weighted_retention == pytest.approx(2 / 3)
    assert (got[2].users, got[2].weighted_retention) == (2, 1.0)


def test_hot_user_counts_once_per_day(spark):
    reg = spark.createDataFrame([(0, 1), (0, 2)], "reg_ts long, uid long")
    auth = spark.range(20000).selectExpr("id % 86400 * 4 as auth_ts", "cast(1 as long) as uid")
    got = cells(calculate_retention(reg, auth, max_days=1))
    assert got == {("1970-01-01", 0): 0.5, ("1970-01-01", 1): None}


def test_checks(spark, players):
    reg, auth = players
    more = spark.createDataFrame(
        [(unix("2023-12-30"), 1), (unix("2024-01-05"), 99), (unix("2024-01-05"), 99)], "auth_ts long, uid long"
    )
    late = spark.createDataFrame([(unix("2024-01-04"), 7)], "reg_ts long, uid long")
    got = retention_checks(reg.unionByName(late), auth.unionByName(more)).first()
    assert got.asDict() == {
        "registered_users": 4, "repeated_users": 0, "authorizations": 10,
        "orphan_authorizations": 2, "early_authorizations": 1, "users_without_d0": 1,
    }


def test_extra_keys(spark, players):
    reg, auth = players
    keyed = reg.selectExpr("*", "if(uid = 1, 'ads', 'organic') as channel")
    got = calculate_retention(keyed, auth, max_days=1, by=["channel"]).collect()
    assert {(r.channel, str(r.cohort_date), r.day): r.active for r in got}["ads", "2024-01-01", 1] == 1
