import pytest

from cohortwise.operators import quality
from cohortwise.sources.schemas import table_schema


def test_nulls_and_duplicates(spark, rows):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x"), (None, "x")], "k long, v string")
    assert rows(quality.null_counts(df), "column_name") == [
        {"column_name": "k", "rows": 4, "nulls": 1}, {"column_name": "v", "rows": 4, "nulls": 2},
    ]
    assert rows(quality.duplicate_counts(df, ["k"])) == [{"rows": 4, "distinct_keys": 2, "duplicates": 2}]
    assert rows(quality.duplicate_counts(df.limit(0), ["k"])) == [{"rows": 0, "distinct_keys": 0, "duplicates": 0}]


def test_exact_duplicates_before_and_after(spark):
    df = spark.createDataFrame(
        [("f", 1.0, 5.0), ("f", 1.0, 5.0), ("f", None, None), ("f", None, None), ("f", 1.0, 6.0)],
        "file string, uid double, revenue double",
    )
    assert quality.exact_duplicates(df, "file", "uid").first().asDict() == {
        "file": "f", "rows": 5, "missing_key": 2, "duplicates_all_rows": 2, "valid_rows": 3, "duplicates_valid_rows": 1,
    }


def test_orphans_with_nulls_on_the_right(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "uid long")
    right = spark.createDataFrame([(2,), (None,)], "uid long")
    row = quality.orphan_counts(left, right, ["uid"], "x").first()
    assert (row.orphan_rows, row.orphan_keys) == (3, 2)


def test_reconciliation(spark):
    users = spark.createDataFrame([("t", 1, 10.0), ("t", 2, 5.0), ("t", 3, 0.0)], "g string, uid long, total_revenue double")
    paid = spark.createDataFrame([(1, 4.0), (1, 6.0), (2, 9.0)], "uid long, revenue double")
    row = quality.reconcile(users, paid, ["uid"], "g").first()
    assert (row.users_revenue, row.transactions_revenue, row.mismatch_users, row.difference) == (15.0, 19.0, 1, 4.0)


def test_chronology_ignores_unreadable_dates(spark):
    df = spark.createDataFrame(
        [("a", "2024-02-01", "2024-01-31"), ("a", "2024-02-01", "2024-31-01"), ("a", "2024-02-01", None), ("a", "2024-02-01", "2024-02-01")],
        "g string, joined string, paid string",
    )
    for fmt in (None, "yyyy-MM-dd"):
        row = quality.chronology(df, "g", df.joined, df.paid, fmt).first()
        assert (row.rows, row.unreadable, row.before_start) == (4, 2, 1)


def test_days(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), ("2024-01-04",), ("2024-01-03",)], "d string").selectExpr("cast(d as date) d")
    assert [str(r[0]) for r in quality.day_gaps(df, "d").collect()] == ["2024-01-02"]
    assert quality.day_checks(df, "d").first().asDict() == {"rows": 4, "days": 3, "duplicate_days": 1, "missing_days": 1}


def test_domain_groups_and_denominators(spark, rows):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 0), (2, 3, 4)], "user_id long, exp_group int, views int")
    assert [(r["value"], r["status"]) for r in rows(quality.domain_check(df, "exp_group", [1, 2, 4]), "value")] == [
        ("1", "ok"), ("2", "ok"), ("3", "unexpected"), ("4", "absent"),
    ]
    assert quality.shared_users(df, "user_id", "exp_group").first().users_in_two_groups == 1
    assert quality.non_positive(df, "views").first().non_positive == 1


def test_ratio_error_skips_zero_denominators(spark):
    df = spark.createDataFrame([(0.5, 1, 2), (0.5, 1, 4), (None, 1, 0)], "ctr double, likes long, views long")
    assert quality.ratio_error(df, "ctr", "likes", "views").first().max_error == 0.25


def test_fan_out_and_contract(spark):
    left = spark.createDataFrame([(1,), (2,)], "uid long")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "uid long, g string")
    row = quality.fan_out(left, left.join(right, "uid", "left"), ["uid"]).first()
    assert (row.rows_before, row.rows_after, row.repeated_keys) == (2, 3, 1)
    ok = quality.contract(right, "r", table_schema(uid="long", g="string"), 2).first()
    bad = quality.contract(right, "r", table_schema(uid="string", g="string"), 3).first()
    assert (ok.header_ok, ok.types_ok, ok.rows_ok) == (True, True, True)
    assert (bad.header_ok, bad.types_ok, bad.rows_ok) == (True, False, False)


def test_require_zero_lists_the_counts(spark):
    checks = spark.createDataFrame([(0, 3)], "gaps int, repeats int")
    quality.require_zero(checks, ["gaps"])
    with pytest.raises(ValueError, match="repeats = 3"):
        quality.require_zero(checks, ["gaps", "repeats"])
