"""Distributed order statistics against pandas, with ties, hot keys and any slicing."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortwise.operators.ordering import approximate_quantiles, exact_quantiles, running_counts
from cohortwise.operators.rank_tests import (
    kruskal_test, mann_whitney_test, rank_sums, unpivot_metrics,
)
from cohortwise.operators import charts


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, nine tenths of one metric at zero."""
    rng = np.random.default_rng(5)
    n = 6000
    pdf = pd.DataFrame({
        "g": np.where(rng.random(n) < 0.34, "hot", np.char.add("g", rng.integers(0, 9, n).astype(str))),
        "arm": rng.integers(0, 3, n),
        "smooth": rng.lognormal(0, 2, n),
        "tied": np.where(rng.random(n) < 0.9, 0.0, rng.integers(1, 50, n)),
    })
    return pdf, spark.createDataFrame(pdf).repartition(5)


@pytest.mark.parametrize("slices", [1, 7, 64])
@pytest.mark.parametrize("value", ["smooth", "tied"])
def test_running_counts(skewed, slices, value):
    pdf, df = skewed
    got = running_counts(df, ["g"], value, slices=slices).toPandas()
    want = pdf.groupby(["g", value]).size().rename("n").reset_index()
    want["running"] = want.groupby("g")["n"].cumsum()
    want["total"] = want.groupby("g")["n"].transform("sum")
    pd.testing.assert_frame_equal(
        got.sort_values(["g", value]).reset_index(drop=True), want, check_dtype=False
    )


@pytest.mark.parametrize("slices", [1, 13])
def test_exact_quantiles(skewed, slices):
    pdf, df = skewed
    wanted = {"q1": 0.25, "median": 0.5, "q95": 0.95}
    for value in ("smooth", "tied"):
        got = exact_quantiles(df, ["g"], value, wanted, slices=slices).toPandas().set_index("g")
        for name, q in wanted.items():
            expected = pdf.groupby("g")[value].quantile(q)
            assert np.allclose(got[name].sort_index(), expected.sort_index())
    one = exact_quantiles(df, [], "smooth", {"median": 0.5}, slices=slices).collect()
    assert len(one) == 1 and one[0].median == pytest.approx(pdf["smooth"].median())


@pytest.mark.parametrize("n, expected", [(1, 1), (9, 9), (10, 10), (20, 19), (11, 10)])
def test_index_quantile_takes_floor_of_q_times_n(spark, n, expected):
    df = spark.range(1, n + 1).selectExpr("1 as g", "cast(id as double) as x")
    assert exact_quantiles(df, ["g"], "x", {"q": 0.9}, by_index=True).first().q == expected


def test_missing_values_and_keys_are_left_out(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", float("nan")), (None, 5.0), ("a", 3.0)], "g string, x double"
    )
    assert exact_quantiles(df, ["g"], "x", {"m": 0.5}).collect() == [("a", 2.0)]


def test_approximate_quantiles_are_close(skewed):
    pdf, df = skewed
    got = approximate_quantiles(df, ["g"], "smooth", {"m": 0.5}).toPandas().set_index("g")["m"]
    want = pdf.groupby("g")["smooth"].median()
    assert np.allclose(got.sort_index(), want.sort_index(), rtol=0.05)


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_mid_ranks(skewed, slices):
    pdf, df = skewed
    long = unpivot_metrics(df, ["arm"], ["smooth", "tied"])
    got = {r.metric: r for r in rank_sums(long, "arm", [0, 1, 2], slices=slices).collect()}
    for metric in ("smooth", "tied"):
        ranks = pdf[metric].rank()
        sums = ranks.groupby(pdf["arm"]).sum()
        t = pdf[metric].value_counts().astype(float)
        r = got[metric]
        assert [r.rank_sum_0, r.rank_sum_1, r.rank_sum_2] == pytest.approx(list(sums))
        assert r.ties == pytest.approx((t**3 - t).sum())


def test_two_group_kruskal_is_squared_mann_whitney(skewed):
    _, df = skewed
    sums = rank_sums(unpivot_metrics(df, ["arm"], ["tied"]), "arm", [0, 1])
    h = kruskal_test(sums, 2).first().h
    row = mann_whitney_test(sums).first()
    n0, n1, n = row.n_0, row.n_1, row.users
    sd = np.sqrt(n0 * n1 / 12 * (n + 1 - row.ties / (n * (n - 1))))
    uncorrected = (row.u - n0 * n1 / 2) / sd
    assert h == pytest.approx(uncorrected**2, rel=1e-9)


def test_mann_whitney_is_symmetric_and_one_at_the_centre(spark):
    df = spark.createDataFrame([(a, float(x)) for a in (0, 1) for x in range(6)], "arm int, x double")
    row = mann_whitney_test(rank_sums(unpivot_metrics(df, ["arm"], ["x"]), "arm", [0, 1])).first()
    assert (row.u, row.p_value) == (18.0, 1.0)


def test_ecdf_and_histogram(skewed):
    pdf, df = skewed
    last = charts.ecdf(df, "g", "smooth").groupBy("g").agg(F.max("share").alias("top"), F.sum("n").alias("n"))
    assert {r.top for r in last.collect()} == {1.0}
    bars = charts.histogram(df, "g", "tied", 15).toPandas()
    assert len(bars) == 15 * pdf["g"].nunique() and bars["count"].sum() == len(pdf)
    width = (pdf["tied"].max() - pdf["tied"].min()) / 15
    assert np.allclose(bars.groupby("g")["density"].sum() * width, 1.0)


def test_box_numbers(skewed):
    pdf, df = skewed
    got = charts.box_numbers(df, "g", "smooth").toPandas().set_index("g")
    values = pdf.loc[pdf["g"] == "hot", "smooth"]
    q1, q3 = values.quantile([0.25, 0.75])
    inside = values.between(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    row = got.loc["hot"]
    assert (row.whisker_low, row.whisker_high) == (values[inside].min(), values[inside].max())
    assert row.outliers == (~inside).sum()


def test_infinite_values_do_not_break_the_slicing(spark):
    df = spark.range(40).selectExpr("1 as g", "if(id < 20, double('inf'), id * 1.0D) as x")
    row = exact_quantiles(df, ["g"], "x", {"q": 0.25, "top": 1.0}, slices=8).first()
    assert row.q == 29.75 and row.top == float("inf")
