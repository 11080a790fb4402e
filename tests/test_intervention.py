import numpy as np
import pandas as pd
import pytest

from cohortwise.operators import intervention

PRE, POST = ("2024-01-01", "2024-02-10"), ("2024-02-11", "2024-02-17")


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(3)
    days = pd.date_range("2024-01-01", "2024-02-20").date
    flat = 100 + rng.normal(0, 2, len(days))
    jump = flat.copy()
    jump[41:48] += 25
    drift = 50 + np.cumsum(rng.normal(0, 1, len(days)))
    pdf = pd.DataFrame({"date": days, "flat": flat, "jump": jump, "drift": drift})
    df = spark.createDataFrame(pdf, "date date, flat double, jump double, drift double")
    return pdf, intervention.long_series(df, "date", ["flat", "jump", "drift"])


def test_mean_effect(series):
    pdf, df = series
    got = {r.metric: r for r in intervention.mean_effect(df, PRE, POST).collect()}
    assert (got["jump"].n_pre, got["jump"].n_post) == (41, 7)
    assert got["jump"].effect == pytest.approx(pdf["jump"][41:48].mean() - pdf["jump"][:41].mean())
    assert got["jump"].result == intervention.GROWTH and got["flat"].result == intervention.UNCLEAR


def test_level_effect(series):
    _, df = series
    forecast = intervention.level_forecast(df, PRE, POST)
    got = {r.metric: r for r in intervention.level_effect(forecast).collect()}
    assert got["jump"].result == intervention.GROWTH and 20 < got["jump"].effect < 30
    assert got["flat"].ci_low < 0 < got["flat"].ci_high
    width = {m: r.ci_high - r.ci_low for m, r in got.items()}
    assert width["drift"] > width["flat"]
    assert forecast.count() == 21


def test_short_or_empty_series_stay_without_forecast(spark):
    df = spark.createDataFrame([("m", "2024-01-01", 1.0)], "metric string, date string, value double").selectExpr(
        "metric", "cast(date as date) date", "value"
    )
    (row,) = intervention.level_forecast(df, PRE, POST).collect()
    assert (row.metric, row.date, row.actual, row.predicted) == ("m", None, None, None)
    (effect,) = intervention.level_effect(intervention.level_forecast(df, PRE, POST)).collect()
    assert (effect.n_post, effect.effect) == (0, None)


def test_missing_days_are_steps():
    values = np.random.default_rng(1).normal(10, 1, 30)
    close = intervention._Level(values, np.ones(29))
    apart = intervention._Level(values, np.r_[np.ones(14), 21.0, np.ones(14)])
    assert apart.predicted != close.predicted
    assert apart.deviation(5.0, 1.0) != close.deviation(5.0, 1.0)
