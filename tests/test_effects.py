import pytest
from pyspark.sql import functions as F

from cohortwise.operators import contingency, effects


def from_counts(spark, counts):
    """Summary rows of 0/1 metrics: arm -> (users, successes)."""
    out = []
    for arm, (n, k) in counts.items():
        p = k / n
        out.append(("cr", arm, n, p, n / (n - 1) * p * (1 - p), float(k)))
    summary = spark.createDataFrame(
        out, "metric string, arm string, n long, mean double, var double, total double"
    )
    return effects.pair(summary, "arm", "a", "b")


@pytest.fixture
def offers(spark):
    return from_counts(spark, {"a": (202103, 1928), "b": (202667, 1805)})


def test_published_proportions(offers):
    row = effects.proportion_test(offers).first()
    assert row.z == pytest.approx(-2.1080, abs=1e-4) and row.p_value == pytest.approx(0.03503, abs=1e-5)
    limits = effects.proportion_intervals(offers).first()
    assert limits.wald_low * 100 == pytest.approx(-0.1222, abs=1e-4)
    assert limits.wald_high * 100 == pytest.approx(-0.0044, abs=1e-4)
    table = effects.effect_table(offers, ["cr"]).first()
    assert table.relative_effect_pct == pytest.approx(-6.640, abs=1e-3) and table.significant


def test_published_payment_test(spark):
    pairs = from_counts(spark, {"a": (1538, 78), "b": (6803, 314)})
    row = effects.proportion_test(pairs).first()
    assert row["diff"] * 100 == pytest.approx(-0.456, abs=1e-3)
    assert row.p_value == pytest.approx(0.4455, abs=1e-4)


def test_sample_ratio(spark):
    users = spark.range(404770).selectExpr("if(id < 202103, 'a', 'b') as arm")
    assert contingency.sample_ratio(users, "arm", {"a": 1, "b": 1}).first().p_value == pytest.approx(0.37535, abs=1e-5)
    fair = contingency.sample_ratio(users, "arm", {"a": 202103, "b": 202667}).first()
    assert fair.chi2 == pytest.approx(0.0, abs=1e-9) and fair.p_value == pytest.approx(1.0)


@pytest.fixture(scope="module")
def users(spark):
    df = spark.range(3000).selectExpr(
        "id", "if(id % 2 = 0, 'a', 'b') as arm", "pmod(hash(id), 1000) / 10.0D as x", "pmod(hash(id, 7), 5) = 0 as paid"
    )
    return df.cache()


def test_uncorrected_chi2_is_squared_z(users):
    cells = contingency.cell_counts(users, "arm", ["a", "b"], ["paid"])
    chi2 = contingency.chi2_test(cells, 2, correction=False).first()
    summary = effects.summarise(users, "arm", {"cr": F.col("paid")})
    z = effects.proportion_test(effects.pair(summary, "arm", "a", "b")).first()
    assert chi2.chi2 == pytest.approx(z.z**2) and chi2.p_value == pytest.approx(z.p_value)
    assert contingency.chi2_test(cells, 2).first().chi2 < chi2.chi2


def test_chi2_agrees_with_spark_ml(spark, users):
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    df = users.selectExpr("pmod(hash(id, 3), 3) as arm", "pmod(hash(id, 11), 6) as f")
    ours = contingency.chi2_test(contingency.cell_counts(df, "arm", [0, 1, 2], ["f"]), 3).first()
    ml = ChiSquareTest.test(
        VectorAssembler(inputCols=["f"], outputCol="v").transform(df.selectExpr("cast(arm as double) arm", "f")), "v", "arm"
    ).first()
    assert ours.chi2 == pytest.approx(ml.statistics[0]) and ours.p_value == pytest.approx(ml.pValues[0])
    assert ours.dof == ml.degreesOfFreedom[0] == 10


def test_zero_cells_and_yates(spark):
    df = spark.createDataFrame([("a", "x")] * 5 + [("b", "y")] * 4, "arm string, f string")
    row = contingency.chi2_test(contingency.cell_counts(df, "arm", ["a", "b"], ["f"]), 2).first()
    assert row.dof == 1 and row.chi2 == pytest.approx(9 * (20 - 4.5) ** 2 / (5 * 4 * 5 * 4))


def test_welch_against_moments(users):
    summary = effects.summarise(users, "arm", {"x": F.col("x")})
    row = effects.welch_test(effects.pair(summary, "arm", "a", "b")).first()
    pdf = users.toPandas()
    a, b = pdf.loc[pdf.arm == "a", "x"], pdf.loc[pdf.arm == "b", "x"]
    se = (a.var() / len(a) + b.var() / len(b)) ** 0.5
    assert row["diff"] == pytest.approx(b.mean() - a.mean()) and row.t == pytest.approx((b.mean() - a.mean()) / se)
    assert row.ci_low < row["diff"] < row.ci_high
    swapped = effects.welch_test(effects.pair(summary, "arm", "b", "a")).first()
    assert swapped.t == pytest.approx(-row.t) and swapped.p_value == pytest.approx(row.p_value)


def test_payers_only_metric_and_empty_arm(spark):
    df = spark.createDataFrame(
        [("a", 0.0), ("a", 10.0), ("a", 20.0), ("b", 0.0), (None, 5.0)], "arm string, rev double"
    )
    summary = effects.summarise(df, "arm", {"arppu": F.when(F.col("rev") > 0, F.col("rev"))})
    row = effects.welch_test(effects.pair(summary, "arm", "a", "b")).first()
    assert (row.n_c, row.mean_c, row.n_t) == (2, 15.0, 0) and row.p_value is None


def test_newcombe_lies_inside_possible_range(spark):
    limits = effects.proportion_intervals(from_counts(spark, {"a": (10, 10), "b": (10, 0)})).first()
    assert -1 <= limits.newcombe_low <= -0.6 and limits.newcombe_high < 0
