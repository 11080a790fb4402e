"""The order of day and month, decided per file."""

from datetime import date, timedelta

import pytest

from cohortwise.operators import quality

DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(0, 300, 3)]
EARLY = [d for d in DAYS if d.day <= 12]


def told(days, order, numbers=None):
    text = "{0.day:02}.{0.month:02}.{0.year}" if order == "d" else "{0.month}/{0.day}/{0.year}"
    return [(n, text.format(d)) for n, d in zip(numbers or range(len(days)), days)]


@pytest.fixture(scope="module")
def rows(spark):
    files = {
        "days": told(DAYS, "d"), "months": told(DAYS, "m"), "rising_days": told(EARLY, "d"), "rising_months": told(EARLY, "m"),
        "shuffled": told(EARLY, "d", [(i * 37) % 101 for i in range(len(EARLY))]), "both": told(DAYS, "d") + told(DAYS, "m"),
        "odd": [(1, "31.02.2024"), (2, "x"), (3, None), (4, ""), (5, "13.13.2024")], "one": [(1, "05.05.2024")],
    }
    out = [(f, n, t) for f, own in files.items() for n, t in own] + [(None, 1, "13.01.2024")]
    return spark.createDataFrame(out, "file string, payment_id long, paid_at string")


def test_orders(rows):
    got = {r.file: r for r in quality.date_order_report(rows, "file", "paid_at", "payment_id").collect()}
    assert {f: r.order for f, r in got.items()} == {
        "days": quality.DAY_FIRST, "months": quality.MONTH_FIRST, "rising_days": quality.DAY_FIRST,
        "rising_months": quality.MONTH_FIRST, "shuffled": quality.UNDECIDED, "both": quality.UNDECIDED,
        "odd": quality.UNDECIDED, "one": quality.UNDECIDED,
    }
    assert got["days"].told == len(DAYS) and got["rising_months"].told == len(EARLY)
    assert got["shuffled"].told == sum(d.day == d.month for d in EARLY) and got["one"].told == 1
    assert (got["odd"].dates, got["odd"].unreadable, got["odd"].told) == (4, 4, 0)


def test_swapped_file_is_recovered(rows):
    orders = quality.date_orders(rows, "file", "paid_at", "payment_id")
    got = quality.dated(rows, orders, "file", "paid_at").where("file = 'months'").orderBy("payment_id").collect()
    assert [r.date for r in got] == DAYS
    assert quality.dated(rows, orders, "file", "paid_at").count() == rows.count()
