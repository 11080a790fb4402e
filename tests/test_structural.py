"""The structural model against dense Gaussian algebra, made-up series and published verdicts."""

import numpy as np
import pandas as pd
import pytest

from cohortwise.operators import structural as st

# Three daily series of the published mart, from 2026-05-30 on.
DAU = [
    878, 2238, 3105, 3721, 4617, 4728, 4890, 5878, 6771, 7667, 7773, 8891, 8641, 8567, 8980, 9660, 10312, 10914,
    11239, 10884, 10814, 11567, 11739, 12501, 12597, 13207, 12696, 12651, 12968, 13201, 13928, 14540, 14774, 14276,
    13996, 14517, 14593, 15414, 15352, 15549, 17452, 14829, 15526, 15867, 16341, 16469, 16632, 16705, 16195, 14073,
    17510, 17703, 18134, 18651, 18365, 18038, 18623, 19376, 19594, 20061, 20400, 20198, 19878,
]
PRE, POST = ("2026-05-30", "2026-07-09"), ("2026-07-10", "2026-07-16")


def dense(model, days, chosen):
    """Mean and covariance of all states, and of the observations, without any recursion."""
    mean, spread = model.start(0.0, 1)
    size, move = model.size, model.moves(chosen)[0]
    drift = np.diag(model.drift(chosen)[0])
    means, blocks = [mean[0]], [[spread[0]]]
    for day in range(1, days):
        means.append(move @ means[-1])
        row = [move @ b for b in blocks[-1]]
        blocks.append([*row, move @ blocks[-1][-1] @ move.T + drift])
    cov = np.zeros((days * size, days * size))
    for i, row in enumerate(blocks):
        for j, b in enumerate(row):
            cov[i * size:(i + 1) * size, j * size:(j + 1) * size] = b
            cov[j * size:(j + 1) * size, i * size:(i + 1) * size] = b.T
    return np.concatenate(means), cov, np.kron(np.eye(days), model.look)


@pytest.mark.parametrize("season, slope", [(7, True), (7, False), (0, True), (3, True)])
def test_filter_and_smoother_equal_dense_algebra(season, slope):
    rng = np.random.default_rng(1)
    model = st.Model(season, slope)
    values = rng.standard_normal(15).cumsum() / 3
    values[0] = 0.0
    values[[4, 5, 11]] = np.nan
    chosen = np.array([[0.3, 0.05, 0.02, 0.04, 0.7]])
    mean, cov, look = dense(model, 15, chosen)
    known = ~np.isnan(values)
    look, y = look[known], values[known]
    total = look @ cov @ look.T + 0.3 * np.eye(len(y))
    error = y - look @ mean
    log = -0.5 * (error @ np.linalg.solve(total, error) + np.linalg.slogdet(2 * np.pi * total)[1])
    assert model.filter(values, chosen).log_likelihood[0] == pytest.approx(log, abs=1e-8)
    gain = cov @ look.T @ np.linalg.inv(total)
    after, left = mean + gain @ error, cov - gain @ look @ cov
    smooth, spread = model.smooth(values, chosen)
    assert np.allclose(smooth[:, 0].ravel(), after, atol=1e-7)
    for day in range(15):
        part = slice(day * model.size, (day + 1) * model.size)
        assert np.allclose(spread[day, 0], left[part, part], atol=1e-7)


def series(values, start="2026-01-01", metric="m"):
    days = pd.date_range(start, periods=len(values))
    return pd.DataFrame({"metric": metric, "date": days.date, "value": np.asarray(values, dtype=float)})


def effects(spark, frame, **options):
    df = spark.createDataFrame(frame, "metric string, date date, value double")
    out = st.structural_effect(st.structural_forecast(df, *options.pop("periods"), **options))
    return {r.metric: r for r in out.collect()}


def test_season_trend_and_jump_are_told_apart(spark):
    rng = np.random.default_rng(5)
    days = np.arange(70)
    quiet = 100 + 3 * np.sin(2 * np.pi * days / 7) * 5 + rng.normal(0, 2, 70)
    jump = quiet + np.where(days >= 60, 25.0, 0.0)
    rows = pd.concat([series(quiet, metric="quiet"), series(jump, metric="jump"), series(-jump, metric="fall")])
    got = effects(spark, rows, periods=(("2026-01-01", "2026-03-01"), ("2026-03-02", "2026-03-11")))
    assert got["jump"].result == "рост" and abs(got["jump"].effect - 25) < 4 and got["jump"].p_value < 0.01
    assert got["fall"].result == "снижение" and abs(got["fall"].effect + 25) < 4
    assert got["quiet"].result == "нет убедительного изменения"
    again = effects(spark, rows, periods=(("2026-01-01", "2026-03-01"), ("2026-03-02", "2026-03-11")))
    assert again == got


def test_evidence_decides_about_the_slope():
    rng = np.random.default_rng(2)
    rising = np.minimum(np.arange(60), 45) / 20 + rng.normal(0, 0.05, 60)
    flat = rng.normal(0, 1, 60)
    scaled = lambda v: (v - v.mean()) / v.std(ddof=1)
    share = lambda v: st.weighed(scaled(v), st.models(7, None), np.random.default_rng(1), 500)[1][2]
    assert share(rising) > 0.95 and share(flat) < 0.9


def test_published_series_of_daily_users(spark):
    got = effects(spark, series(DAU, "2026-05-30", "dau"), periods=(PRE, POST))["dau"]
    assert got.n_post == 7 and got.result == "нет убедительного изменения"
    assert abs(got.effect) < 2000 and got.ci_high - got.ci_low < 4000


def test_components_add_up(spark):
    rng = np.random.default_rng(3)
    days = np.arange(56)
    weekly = 10 * np.sin(2 * np.pi * days / 7)
    frame = series(50 + weekly + rng.normal(0, 1, 56))
    df = spark.createDataFrame(frame, "metric string, date date, value double").where("date <> '2026-01-20'")
    got = st.structural_components(df, ("2026-01-01", "2026-02-25")).orderBy("date").toPandas()
    assert len(got) == 55
    assert np.allclose(got.level + got.season + got.rest, got.value)
    keep = np.array(frame.date.isin(got.date))
    assert np.corrcoef(got.season, weekly[keep])[0, 1] > 0.97
    assert abs(got.level - 50).max() < 3


def test_short_empty_and_odd_series(spark):
    rows = pd.concat([
        series([1.0, 2.0], metric="short"), series([5.0] * 20, metric="constant"),
        series([None] * 20, metric="nothing"), series([1.0, 2.0, 3.0, 2.0], metric="no_later"),
    ])
    got = effects(spark, rows, periods=(("2026-01-01", "2026-01-15"), ("2026-01-16", "2026-01-20")))
    assert got["constant"].effect == pytest.approx(0, abs=2) and got["no_later"].effect is None
    assert got["nothing"].n_post == 0 and got["short"].n_post == 0
    empty = spark.createDataFrame([], "metric string, date date, value double")
    assert st.structural_components(empty, PRE).count() == 0
    assert st.structural_forecast(empty, PRE, POST).count() == 0
