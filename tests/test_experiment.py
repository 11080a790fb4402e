import pytest
from pyspark.sql import functions as F

from cohortwise.operators import experiment, segments


def test_late_assignment_wins_and_nonpayers_stay(spark, rows):
    groups = spark.createDataFrame([(1, "A"), (2, "A"), (3, "B")], "student_id long, grp string")
    late = spark.createDataFrame([(2, "B"), (4, "A")], "student_id long, grp string")
    active = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "student_id long")
    checks = spark.createDataFrame([(2, 50.0), (2, 40.0), (9, 7.0)], "student_id long, rev double")
    got = rows(experiment.recalculate_metrics(groups, late, active, checks), "grp")
    assert [(r["grp"], r["users"], r["payers"], r["revenue"]) for r in got] == [("A", 2, 0, 0.0), ("B", 2, 1, 90.0)]
    assert got[0]["arppu"] is None and got[1]["arppu"] == 90.0 and got[1]["cr"] == 0.5


def test_order_inside_a_batch(spark, rows):
    batch = spark.createDataFrame([(1, "A", 1), (1, "B", 2)], "student_id long, grp string, line int")
    assert rows(experiment.latest_assignment([batch], order="line")) == [{"student_id": 1, "grp": "B"}]


def test_recalculation_from_files(spark, tmp_path, rows):
    (tmp_path / "groups.csv").write_text("id;grp\n1;A\n2;B\n")
    (tmp_path / "late.csv").write_text("student,group\n2,A\n")
    (tmp_path / "active.csv").write_text("student_id\n1\n2\n")
    (tmp_path / "checks.csv").write_text("student_id;rev\n2;10.5\n")
    got = rows(experiment.recalculate_from_files(
        spark, *[str(tmp_path / f"{n}.csv") for n in ("groups", "late", "active", "checks")]
    ))
    assert [(r["grp"], r["users"], r["revenue"]) for r in got] == [("A", 2, 10.5)]


def test_product_table_keeps_users_and_sums_first(spark, rows):
    users = spark.createDataFrame(
        [("test", 1, 30.0), ("test", 2, 0.0)], "group string, uid long, total_revenue double"
    )
    bought = spark.createDataFrame(
        [("test", 1.0, "premium_no_trial", 10.0), ("test", 1.0, "premium_no_trial", 10.0),
         ("test", 1.0, "trial_premium", 10.0), ("control_1", 2.0, "premium_no_trial", 5.0),
         ("test", None, None, None)],
        "group string, uid double, product_type string, revenue double",
    )
    valid = experiment.valid_transactions(bought)
    assert valid.count() == 4 and valid.schema["uid"].dataType.simpleString() == "bigint"
    got = rows(experiment.product_user_table(users, valid), "uid")
    assert [(r["premium_revenue"], r["premium_transactions"], r["trial_buyer"], r["payer"]) for r in got] == [
        (20.0, 2, True, True), (0.0, 0, False, False),
    ]


def test_spike_rounds_half_to_even(spark):
    paid = spark.createDataFrame(
        [("B", 1899.5), ("B", 1900.5), ("B", 1901.0), ("B", 0.0), (None, 1900.0)], "grp string, rev double"
    )
    row = experiment.payment_spike(paid, "grp", "rev", 1900.0).first()
    assert (row.payers, row.spike_payers) == (3, 2)


def test_large_payers(spark):
    df = spark.createDataFrame([("a", 35000.0), ("a", 5000.0), ("a", 0.0), ("b", 0.0)], "g string, r double")
    got = {r.g: r for r in experiment.large_payers(df, "g", "r", 35000).collect()}
    assert (got["a"].payer_share, got["a"].revenue_share) == (0.5, 0.875) and got["b"].payer_share is None


def test_price_by_country_needs_buyers_in_both_arms(spark):
    df = spark.createDataFrame(
        [("x", "control", 1, 10.0), ("x", "control", 2, 20.0), ("x", "test", 3, 30.0), ("x", "test", 4, 30.0),
         ("y", "control", 5, 10.0), ("y", "control", 5, 10.0), ("y", "test", 6, 1.0), ("y", "test", 7, 1.0)],
        "country string, comparison string, uid long, revenue double",
    )
    got = experiment.price_by_country(df).collect()
    assert [(r.country, r.control_median, r.price_ratio) for r in got] == [("x", 15.0, 2.0)]


def test_segments_and_rounding(spark, rows):
    customers = spark.sql("""select * from values
        (1L, 'a', timestamp_ntz'2024-01-01 10:00:00'), (2L, 'a', timestamp_ntz'2024-01-01 00:00:00'),
        (3L, 'b', timestamp_ntz'2024-03-01 00:00:00'), (4L, 'b', timestamp_ntz'2024-02-29 00:00:00')
        as t(customer_id, customer_city, created_at)""")
    orders = spark.sql("""select * from values
        (1L, 'Delivered', timestamp_ntz'2024-02-01 00:00:00', timestamp_ntz'2024-02-02 00:00:00'),
        (1L, 'Delivered', timestamp_ntz'2024-02-01 00:00:00', timestamp_ntz'2024-02-03 12:00:00'),
        (1L, 'Delivered', timestamp_ntz'2024-02-01 00:00:00', null),
        (2L, 'Delivered', timestamp_ntz'2024-02-01 00:00:00', timestamp_ntz'2024-02-01 03:00:00'),
        (2L, 'Cancelled', timestamp_ntz'2024-02-01 00:00:00', timestamp_ntz'2024-02-09 00:00:00')
        as t(customer_id, order_status, order_created_time, order_delivered_customer_time)""")
    actions = spark.createDataFrame([(1, "Purchase"), (1, "View"), (3, "View")], "customer_id long, event_type string")
    got = rows(segments.customer_segments(customers, orders, actions, "2024-03-31"), "customer_id")
    assert [r["segment"] for r in got] == [segments.REGULAR, segments.ONE_OFF, segments.NEW, segments.INACTIVE]
    assert [r["days_since_registration"] for r in got] == [90, 90, 30, 31]
    assert [r["avg_delivery_days"] for r in got] == [1.75, 0.13, None, None]
    assert [r["purchase_events_count"] for r in got] == [1, 0, 0, 0]
    assert got[0]["orders_count"] == 3


def test_pooling_keeps_other_groups(spark):
    df = spark.createDataFrame([("control_1",), ("control_2",), ("test",)], "group string")
    assert [r.comparison for r in experiment.pooled(df).orderBy("group").collect()] == ["control", "control", "test"]
