"""Structural time series of an intervention: level, slope and weekly season.

A series holds one row per calendar day. Its state is a level that drifts, a slope that drifts
and fades, and a season whose days sum to about zero; a Kalman filter gives the likelihood of
the four variances and the fading, for many sets of them at once, and the forecast from each
set. They are drawn by importance sampling: widely first, then around what the first
draws found. Whether a series has a slope at all is decided by the evidence of both models,
which share the draws in its proportion. Every draw adds a path of the later period, so intervals hold the uncertainty of variances,
state and noise together. Draws are seeded by the series' key, hence equal on every retry.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Sequence
from math import lgamma
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from cohortwise.operators.intervention import verdict

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASON = 7
#: Prior guesses of the daily steps, as shares of the series' deviation, with their weight in
#: observations; the published causal-impact default for the level.
STEPS, PRIOR_WEIGHT = (0.01, 0.01, 0.01), 32.0
#: Share of the deviation that is taken for noise (a fit of 80 %), with hardly any weight. The
#: share of a slope that is left a day later is uniform between 0 and 1.
NOISE, NOISE_WEIGHT = 0.2**0.5, 1.0
DRAWS = 1000
#: Points that the later draws lie around.
CENTRES = 200


class Filtered(NamedTuple):
    """Outcome of the filter for a batch of variances: axes are (day, draw, state...)."""

    log_likelihood: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    before_mean: np.ndarray
    before_spread: np.ndarray


class Model:
    """Matrices of the state (level, slope, season of the latest days)."""

    def __init__(self, season: int = SEASON, slope: bool = True):
        self.season, self.slope = season, slope
        rest = max(season - 1, 0)
        size = 2 + rest
        move = np.zeros((size, size))
        move[0, 0] = 1.0
        move[0, 1] = move[1, 1] = 1.0 if slope else 0.0
        if rest:
            move[2, 2:] = -1.0
            move[range(3, size), range(2, size - 1)] = 1.0
        self.move, self.size = move, size
        self.look = np.zeros(size)
        self.look[0] = 1.0
        if rest:
            self.look[2] = 1.0

    def moves(self, chosen: np.ndarray) -> np.ndarray:
        """A matrix for each set: the slope keeps its own share from day to day."""
        out = np.broadcast_to(self.move, (len(chosen), self.size, self.size)).copy()
        if self.slope:
            out[:, 1, 1] = chosen[:, 4]
        return out

    def drift(self, variances: np.ndarray) -> np.ndarray:
        """Diagonal of the state noise for rows of noise, level, slope and season variances
        and the share of the slope."""
        out = np.zeros((len(variances), self.size))
        out[:, 0] = variances[:, 1]
        if self.slope:
            out[:, 1] = variances[:, 2]
        if self.size > 2:
            out[:, 2] = variances[:, 3]
        return out

    def start(self, first: float, draws: int) -> tuple[np.ndarray, np.ndarray]:
        """Wide prior of the first day's state, in units of the series' deviation."""
        mean = np.zeros((draws, self.size))
        mean[:, 0] = first
        spread = np.diag([1.0, 0.01 if self.slope else 0.0, *[0.25] * (self.size - 2)])
        return mean, np.broadcast_to(spread, (draws, self.size, self.size)).copy()

    def filter(self, values: np.ndarray, variances: np.ndarray) -> Filtered:
        """Kalman filter of daily values; a missing day (NaN) is a step without an update."""
        draws = len(variances)
        known = values[~np.isnan(values)]
        mean, spread = self.start(known[0] if len(known) else 0.0, draws)
        drift, move = self.drift(variances), self.moves(variances)
        turned = move.transpose(0, 2, 1)
        total = np.zeros(draws)
        kept: list[list[np.ndarray]] = [[], [], [], []]
        for day, value in enumerate(values):
            if day:
                mean = (move @ mean[:, :, None])[:, :, 0]
                spread = move @ spread @ turned
                spread[:, range(self.size), range(self.size)] += drift
            kept[2].append(mean)
            kept[3].append(spread)
            if not np.isnan(value):
                reach = spread @ self.look
                scale = reach @ self.look + variances[:, 0]
                error = value - mean @ self.look
                gain = reach / scale[:, None]
                mean = mean + gain * error[:, None]
                spread = spread - gain[:, :, None] * reach[:, None, :]
                total -= 0.5 * (np.log(2 * np.pi * scale) + error**2 / scale)
            kept[0].append(mean)
            kept[1].append(spread)
        return Filtered(total, *map(np.array, kept))

    def smooth(self, values: np.ndarray, variances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean and spread of every day's state given all days (one set of variances a draw)."""
        found = self.filter(values, variances)
        mean, spread = found.mean.copy(), found.spread.copy()
        turned = self.moves(variances).transpose(0, 2, 1)
        for day in range(len(values) - 2, -1, -1):
            ahead = found.before_spread[day + 1]
            # The least-squares inverse serves states without any spread.
            back = found.spread[day] @ turned @ np.linalg.pinv(ahead, hermitian=True)
            mean[day] += np.einsum("dij,dj->di", back, mean[day + 1] - found.before_mean[day + 1])
            spread[day] += back @ (spread[day + 1] - ahead) @ back.transpose(0, 2, 1)
        return mean, spread


def _guesses() -> tuple[np.ndarray, np.ndarray]:
    return np.array([NOISE, *STEPS]) ** 2, np.array([NOISE_WEIGHT, *[PRIOR_WEIGHT] * 3])


def _inverse_chi(logs: np.ndarray, guess: float, weight: float) -> np.ndarray:
    """Log density of the logarithm of a scaled inverse chi-square variable."""
    half = weight / 2
    return half * np.log(half * guess) - lgamma(half) - half * logs - half * guess * np.exp(-logs)


def _log_prior(free: np.ndarray, used: Sequence[int]) -> np.ndarray:
    """Log density of log variances and of the logit of the slope's share."""
    guesses, weight = _guesses()
    total = np.zeros(len(free))
    for column, k in zip(free.T, used):
        if k < 4:
            total += _inverse_chi(column, guesses[k], weight[k])
        else:
            total -= np.logaddexp(0, column) + np.logaddexp(0, -column)
    return total


def _first(used: Sequence[int], rng: np.random.Generator, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws half from the prior and half wide, each number for itself, and their log density.

    The posterior may have several tops, such as much noise or a quick level.
    """
    guesses, weight = _guesses()
    low, high = 2 * np.log(1e-4), 2 * np.log(2.0)
    columns, density = [], np.zeros(n)
    for k in used:
        if k == 4:
            column = rng.logistic(size=n)
            density -= np.logaddexp(0, column) + np.logaddexp(0, -column)
        else:
            near = np.log(weight[k] * guesses[k]) - np.log(np.maximum(rng.chisquare(weight[k], n), 1e-9))
            column = np.where(rng.random(n) < 0.5, near, rng.uniform(low, high, n))
            inside = np.where((column >= low) & (column <= high), -np.log(high - low), -np.inf)
            density += np.logaddexp(_inverse_chi(column, guesses[k], weight[k]), inside) + np.log(0.5)
        columns.append(column)
    return np.column_stack(columns), density


def _kernels(
    centres: np.ndarray, wide: np.ndarray, rng: np.random.Generator, n: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Draws around centres with heavy tails, and their log density."""
    size = centres.shape[1]
    root = np.linalg.cholesky(wide)
    unit = rng.standard_normal((n, size)) * np.sqrt(5.0 / rng.chisquare(5.0, n))[:, None]
    out = centres[rng.integers(len(centres), size=n)] + unit @ root.T
    apart = np.linalg.solve(root, (out[:, None] - centres[None]).reshape(-1, size).T)
    log = -(5.0 + size) / 2 * np.log1p((apart**2).sum(axis=0) / 5.0).reshape(n, -1)
    scale = lgamma((5.0 + size) / 2) - lgamma(2.5) - size / 2 * np.log(5 * np.pi) - np.log(np.diag(root)).sum()
    top = log.max(axis=1)
    return out, top + np.log(np.exp(log - top[:, None]).mean(axis=1)) + scale


def posterior(
    values: np.ndarray, model: Model, rng: np.random.Generator, draws: int,
) -> tuple[np.ndarray, float]:
    """Draws of noise, level, slope and season variances and the slope's share, and the log
    evidence, of a scaled series. What the model does not use stays at its guess."""
    used = [0, 1, *([2] if model.slope else []), *([3] if model.size > 2 else []), *([4] if model.slope else [])]
    guess = np.append(_guesses()[0], 0.5)[None]

    def filled(free: np.ndarray) -> np.ndarray:
        out = np.repeat(guess, len(free), axis=0)
        for column, k in zip(free.T, used):
            out[:, k] = np.exp(column) if k < 4 else 1 / (1 + np.exp(-column))
        return out

    def weights(free: np.ndarray, density: np.ndarray) -> tuple[np.ndarray, float]:
        found = model.filter(values, filled(free)).log_likelihood + _log_prior(free, used) - density
        share = np.exp(found - found.max())
        return share / share.sum(), float(np.log(share.mean()) + found.max())

    free, density = _first(used, rng, 4 * draws)
    share, evidence = weights(free, density)
    for _ in range(2):
        centre = share @ free
        wide = 0.3 * ((free - centre).T * share) @ (free - centre) + 0.01 * np.eye(len(used))
        free, density = _kernels(free[rng.choice(len(free), CENTRES, p=share)], wide, rng, 2 * draws)
        share, evidence = weights(free, density)
    return filled(free[rng.choice(len(free), draws, p=share)]), evidence


def models(season: int, slope: bool | None) -> list[Model]:
    """The model with a slope, the one without, or both."""
    return [Model(season, x) for x in ((False, True) if slope is None else (slope,))]


def weighed(
    values: np.ndarray, candidates: Sequence[Model], rng: np.random.Generator, draws: int,
) -> list[tuple[Model, np.ndarray, float]]:
    """Each model with its draws and its probability; the models are equally likely before."""
    found = [(model, *posterior(values, model, rng, draws)) for model in candidates]
    share = np.exp([x[2] - max(y[2] for y in found) for x in found])
    return [(model, sets, p) for (model, sets, _), p in zip(found, share / share.sum())]


def paths(
    values: np.ndarray, ahead: int, candidates: Sequence[Model], rng: np.random.Generator, draws: int,
) -> np.ndarray:
    """Draws of the next ``ahead`` values of a scaled series: rows are draws."""
    out = []
    for model, sets, share in weighed(values, candidates, rng, draws):
        mine = sets[:int(round(share * draws))]
        if len(mine):
            out.append(_walk(values, ahead, model, mine, rng))
    return np.concatenate(out)


def _walk(values: np.ndarray, ahead: int, model: Model, sets: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    found = model.filter(values, sets)
    drift, move = np.sqrt(model.drift(sets)), model.moves(sets)
    # A root that also serves states without any spread.
    size, vectors = np.linalg.eigh(found.spread[-1])
    root = vectors * np.sqrt(np.maximum(size, 0.0))[:, None, :]
    state = found.mean[-1] + np.einsum("dij,dj->di", root, rng.standard_normal((len(sets), model.size)))
    out = np.empty((len(sets), ahead))
    for day in range(ahead):
        state = (move @ state[:, :, None])[:, :, 0] + drift * rng.standard_normal(state.shape)
        out[:, day] = state @ model.look + np.sqrt(sets[:, 0]) * rng.standard_normal(len(sets))
    return out


def _daily(series: pd.DataFrame, first: pd.Timestamp, last: pd.Timestamp) -> np.ndarray:
    """Values of every day of a period; days without a value are NaN."""
    days = pd.date_range(first, last)
    dated = pd.Series(series["value"].to_numpy(dtype=float), index=pd.to_datetime(series["date"]))
    return dated.groupby(level=0).mean().reindex(days).to_numpy()


def _seed(key: Sequence[object]) -> np.random.Generator:
    return np.random.default_rng(zlib.crc32("\x1f".join(map(str, key)).encode()))


def _forecast(group: pd.DataFrame, key, pre, post, candidates: Sequence[Model], draws: int, outside: float) -> pd.DataFrame:
    columns = ["date", "actual", "predicted", "low", "high", "effect", "ci_low", "ci_high", "p_value"]
    dates = pd.to_datetime(group["date"])
    known = group.assign(date=dates).dropna(subset=["value"])
    later = known[known["date"].between(*map(pd.Timestamp, post))].sort_values("date")
    earlier = known[known["date"].between(*map(pd.Timestamp, pre))]
    if later.empty:
        return pd.DataFrame({c: [None] for c in columns})
    if len(earlier) < 3:
        kept = pd.DataFrame({"date": later["date"], "actual": later["value"]})
        return kept.reindex(columns=columns).astype({c: float for c in columns[2:]})
    centre, unit = earlier["value"].mean(), earlier["value"].std(ddof=1) or 1.0
    first = earlier["date"].min()
    scaled = (_daily(earlier, first, pd.Timestamp(pre[1])) - centre) / unit
    ahead = (later["date"] - pd.Timestamp(pre[1])).dt.days.to_numpy()
    drawn = centre + unit * paths(scaled, int(ahead.max()), candidates, _seed(key), draws)[:, ahead - 1]
    actual = later["value"].to_numpy(dtype=float)
    low, high = np.quantile(drawn, [outside, 1 - outside], axis=0)
    mean = drawn.mean(axis=1)
    gap = actual.mean() - mean
    # Chance of a mean at least as far out on its side, as in a one-sided test.
    tail = min((mean >= actual.mean()).sum(), (mean <= actual.mean()).sum())
    ends = np.quantile(gap, [outside, 1 - outside])
    return pd.DataFrame({
        "date": later["date"].to_numpy(), "actual": actual, "predicted": drawn.mean(axis=0), "low": low,
        "high": high, "effect": gap.mean(), "ci_low": ends[0], "ci_high": ends[1],
        "p_value": (tail + 1) / (len(drawn) + 1),
    })


def _typed(series: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"{k} {series.schema[k].dataType.simpleString()}" for k in keys)


def structural_forecast(
    series: DataFrame, pre: tuple[str, str], post: tuple[str, str], keys: Sequence[str] = ("metric",),
    season: int = SEASON, slope: bool | None = None, confidence: float = 0.95, draws: int = DRAWS,
) -> DataFrame:
    """Fact against the structural counterfactual, per series and day of the later period.

    ``effect``, its interval and ``p_value`` are those of the mean over the period, repeated on
    its days. A series with fewer than three earlier values keeps its days without a forecast;
    one without later values keeps one row without a date. ``season`` below 2 leaves it out, ``slope`` keeps
    to the model with or without one.
    """
    keys, candidates, outside = list(keys), models(season, slope), (1 - confidence) / 2

    def forecast(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = _forecast(group, key, pre, post, candidates, draws, outside)
        for position, name in enumerate(keys):
            out.insert(position, name, group[name].iloc[0])
        return out

    numbers = ", ".join(f"{c} double" for c in (
        "actual", "predicted", "low", "high", "effect", "ci_low", "ci_high", "p_value"
    ))
    return series.select(*keys, "date", "value").groupBy(*keys).applyInPandas(
        forecast, f"{_typed(series, keys)}, date date, {numbers}"
    )


def structural_effect(forecast: DataFrame, keys: Sequence[str] = ("metric",)) -> DataFrame:
    """One row per series: mean fact and forecast, effect, relative effect, interval, verdict."""
    once = [F.first(c).alias(c) for c in ("effect", "ci_low", "ci_high", "p_value")]
    out = forecast.groupBy(*keys).agg(
        F.count("actual").alias("n_post"), F.avg("actual").alias("actual"),
        F.avg("predicted").alias("predicted"), *once,
    )
    relative = F.try_divide(F.col("effect"), F.col("predicted")) * 100
    return out.withColumn("effect_pct", relative).withColumn("result", verdict())


def structural_components(
    series: DataFrame, period: tuple[str, str], keys: Sequence[str] = ("metric",),
    season: int = SEASON, slope: bool | None = None, draws: int = DRAWS,
) -> DataFrame:
    """Smoothed level, slope, season and remainder of every day of a period with a value.

    The likelier model is taken. Variances and the slope's share are posterior means, those of variances of logarithms. Series of fewer than three
    values have no rows.
    """
    keys, candidates = list(keys), models(season, slope)
    parts = ["value", "level", "slope", "season", "rest"]

    def split(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        dates = pd.to_datetime(group["date"])
        known = group.assign(date=dates).dropna(subset=["value"])
        known = known[known["date"].between(*map(pd.Timestamp, period))]
        out = pd.DataFrame({c: [] for c in ["date", *parts]})
        if len(known) >= 3:
            centre, unit = known["value"].mean(), known["value"].std(ddof=1) or 1.0
            days = pd.date_range(known["date"].min(), known["date"].max())
            raw = _daily(known, days[0], days[-1])
            scaled = (raw - centre) / unit
            model, sets, _ = max(weighed(scaled, candidates, _seed(key), draws), key=lambda x: x[2])
            chosen = np.append(np.exp(np.log(sets[:, :4]).mean(axis=0)), sets[:, 4].mean())[None]
            mean = model.smooth(scaled, chosen)[0][:, 0]
            found = {"level": centre + unit * mean[:, 0], "slope": unit * mean[:, 1]}
            found["season"] = unit * mean[:, 2] if model.size > 2 else np.zeros(len(days))
            rest = raw - found["level"] - found["season"]
            out = pd.DataFrame({"date": days, "value": raw, **found, "rest": rest}).dropna(subset=["value"])
        for position, name in enumerate(keys):
            out.insert(position, name, group[name].iloc[0])
        return out

    numbers = ", ".join(f"{c} double" for c in parts)
    return series.select(*keys, "date", "value").groupBy(*keys).applyInPandas(
        split, f"{_typed(series, keys)}, date date, {numbers}"
    )
