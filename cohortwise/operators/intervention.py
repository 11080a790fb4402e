"""Effect of an intervention on daily series without a control series.

Two counterfactuals: the mean of the period before, in plain aggregates, and a
local-level model fitted per series inside ``applyInPandas``. A series holds one row per
calendar day, so a group is as long as the calendar, not as the event log.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.functions.columns import in_days, ratio
from cohortwise.functions.distributions import t_critical

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The verdicts growth, decline and no convincing change.
GROWTH, DECLINE, UNCLEAR = "рост", "снижение", "нет убедительного изменения"


def long_series(mart: DataFrame, day: str, metrics: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Daily mart to ``keys..., date, metric, value``."""
    wide = mart.select(
        *keys, F.col(day).cast("date").alias("date"), *[F.col(m).cast("double").alias(m) for m in metrics]
    )
    return wide.unpivot([*keys, "date"], list(metrics), "metric", "value")


def verdict() -> Column:
    return (
        F.when((F.col("ci_low") <= 0) & (F.col("ci_high") >= 0), UNCLEAR)
        .when(F.col("effect") > 0, GROWTH)
        .when(F.col("effect") <= 0, DECLINE)
    )


def mean_effect_statistic(
    series: DataFrame, pre: tuple[str, str], post: tuple[str, str], keys: Sequence[str] = ("metric",)
) -> DataFrame:
    """Per series: mean before and after, their difference, pooled standard error and dof."""
    before, after = in_days(F.col("date"), *pre), in_days(F.col("date"), *post)

    def over(period: Column, suffix: str) -> list[Column]:
        kept = F.when(period, F.col("value"))
        return [
            F.count(kept).alias(f"n_{suffix}"),
            F.avg(kept).alias(f"mean_{suffix}"),
            F.coalesce(F.var_samp(kept), F.lit(0.0)).alias(f"_var_{suffix}"),
        ]

    reduced = series.where(before | after).groupBy(*keys).agg(*over(before, "pre"), *over(after, "post"))
    dof = (F.col("n_pre") + F.col("n_post") - 2).cast("double")
    square = ratio(
        F.col("_var_pre") * (F.col("n_pre") - 1) + F.col("_var_post") * (F.col("n_post") - 1), dof
    )
    weights = ratio(F.lit(1.0), F.col("n_pre")) + ratio(F.lit(1.0), F.col("n_post"))
    return reduced.select(
        *keys,
        "n_pre",
        "n_post",
        F.col("mean_post").alias("actual"),
        F.col("mean_pre").alias("predicted"),
        (F.col("mean_post") - F.col("mean_pre")).alias("effect"),
        F.sqrt(square * weights).alias("se"),
        dof.alias("dof"),
    )


def mean_effect(
    series: DataFrame, pre: tuple[str, str], post: tuple[str, str],
    keys: Sequence[str] = ("metric",), confidence: float = 0.95,
) -> DataFrame:
    """Interval and verdict with the earlier mean as the counterfactual."""
    margin = t_critical(F.lit(0.5 + confidence / 2), F.col("dof")) * F.col("se")
    return (
        mean_effect_statistic(series, pre, post, keys)
        .withColumn("_margin", margin)
        .withColumn("ci_low", F.col("effect") - F.col("_margin"))
        .withColumn("ci_high", F.col("effect") + F.col("_margin"))
        .drop("_margin")
        .withColumn("result", verdict())
    )


# Default prior of the published structural time-series method for causal impact: the daily
# step of the level is about 1 % of the series' deviation, with the weight of 32 observations.
LEVEL_STEP, PRIOR_WEIGHT = 0.01, 32.0


def _filter_level(values: np.ndarray, gaps: np.ndarray, ratios: np.ndarray):
    """Kalman filter of a random walk plus noise for many variance ratios at once.

    ``gaps`` are the days since the value before; a missing day is a step without an update.
    Variances are in units of the noise variance. Returns the scaled squared one-step
    errors, the sum of log scales, the last level and its variance.
    """
    level = np.full(ratios.shape, values[0])
    spread = np.ones(ratios.shape)
    squares, logs = np.zeros(ratios.shape), np.zeros(ratios.shape)
    for value, gap in zip(values[1:], gaps):
        predicted = spread + gap * ratios
        scale = predicted + 1.0
        error = value - level
        level = level + predicted / scale * error
        spread = predicted / scale
        squares += error**2 / scale
        logs += np.log(scale)
    return squares, logs, level, spread


class _Level:
    """Posterior of the level at the last observed day of the earlier period.

    The ratio of step to noise variance runs over a logarithmic grid; the noise variance is
    integrated out in closed form (it is inverse-gamma given the ratio).
    """

    def __init__(self, values: np.ndarray, gaps: np.ndarray):
        self.centre, self.unit = values.mean(), values.std(ddof=1) or 1.0
        log_ratio = np.linspace(-8.0, 4.0, 1201) * np.log(10.0)
        self.ratio = np.exp(log_ratio)
        squares, logs, self.level, self.spread = _filter_level(
            (values - self.centre) / self.unit, gaps, self.ratio
        )
        shape = (len(values) - 1 + PRIOR_WEIGHT) / 2.0
        rate = (squares + PRIOR_WEIGHT * LEVEL_STEP**2 / self.ratio) / 2.0
        self.noise = rate / (shape - 1.0)
        log_weight = -shape * np.log(rate) - logs / 2.0 - PRIOR_WEIGHT / 2.0 * log_ratio
        weight = np.exp(log_weight - log_weight.max())
        self.weight = weight / weight.sum()
        self.mean = float((self.weight * self.level).sum())

    @property
    def predicted(self) -> float:
        return self.centre + self.unit * self.mean

    def deviation(self, steps: float, observations: float) -> float:
        """Deviation of a forecast error: ``steps`` step variances, ``observations`` noise ones."""
        inside = self.noise * (self.spread + steps * self.ratio + observations)
        between = (self.level - self.mean) ** 2
        return self.unit * float(np.sqrt((self.weight * (inside + between)).sum()))


def _level_forecast(series: pd.DataFrame, pre, post, z: float) -> pd.DataFrame:
    """Per-day forecast of one series over the later period, with the mean effect repeated.

    A series with fewer than three earlier values keeps its days without a forecast; one
    without later values keeps one row without a date.
    """
    series = series.sort_values("date")
    dates = pd.to_datetime(series["date"])
    inside = lambda p: (dates >= pd.Timestamp(p[0])) & (dates <= pd.Timestamp(p[1]))
    earlier = series.loc[inside(pre).to_numpy()].dropna(subset=["value"])
    before = earlier["value"].to_numpy(dtype=float)
    days = pd.to_datetime(earlier["date"])
    later = series.loc[inside(post).to_numpy()].dropna(subset=["value"])
    columns = ["date", "actual", "predicted", "low", "high", "effect", "ci_low", "ci_high"]
    if later.empty:
        return pd.DataFrame({c: [None] for c in columns})
    if len(before) < 3:
        kept = pd.DataFrame({"date": later["date"], "actual": later["value"]})
        return kept.reindex(columns=columns).astype({c: float for c in columns[2:]})
    model = _Level(before, np.diff(days.to_numpy()) / np.timedelta64(1, "D"))
    ahead = (pd.to_datetime(later["date"]) - days.iloc[-1]).dt.days.to_numpy(dtype=float)
    deviation = np.array([model.deviation(h, 1.0) for h in ahead])
    # Forecast errors share the level's path: days h and k have min(h, k) steps in common.
    m = len(ahead)
    mean_deviation = model.deviation(np.minimum.outer(ahead, ahead).sum() / m**2, 1.0 / m)
    actual = later["value"].to_numpy(dtype=float)
    level = model.predicted
    effect = float(actual.mean() - level)
    return pd.DataFrame(
        {
            "date": later["date"].to_numpy(),
            "actual": actual,
            "predicted": level,
            "low": level - z * deviation,
            "high": level + z * deviation,
            "effect": effect,
            "ci_low": effect - z * mean_deviation,
            "ci_high": effect + z * mean_deviation,
        }
    )


def level_forecast(
    series: DataFrame, pre: tuple[str, str], post: tuple[str, str],
    keys: Sequence[str] = ("metric",), confidence: float = 0.95,
) -> DataFrame:
    """Fact against the local-level counterfactual, per series and day of the later period."""
    keys = list(keys)
    z = NormalDist().inv_cdf(0.5 + confidence / 2)

    def forecast(group: pd.DataFrame) -> pd.DataFrame:
        out = _level_forecast(group, pre, post, z)
        for position, key in enumerate(keys):
            out.insert(position, key, group[key].iloc[0])
        return out

    fields = ", ".join(f"{k} {series.schema[k].dataType.simpleString()}" for k in keys)
    numbers = "actual double, predicted double, low double, high double, " \
        "effect double, ci_low double, ci_high double"
    return series.select(*keys, "date", "value").groupBy(*keys).applyInPandas(
        forecast, f"{fields}, date date, {numbers}"
    )


def level_effect(forecast: DataFrame, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """One row per series: mean fact, mean forecast, effect, interval and verdict."""
    return forecast.groupBy(*keys).agg(
        F.count("actual").alias("n_post"),
        F.avg("actual").alias("actual"),
        F.avg("predicted").alias("predicted"),
        F.first("effect").alias("effect"),
        F.first("ci_low").alias("ci_low"),
        F.first("ci_high").alias("ci_high"),
    ).withColumn("result", verdict())
