"""Tail probabilities and quantiles, applied to reduced rows only.

Spark SQL has no error function, so these small Arrow-batched UDFs work on the
handful of rows left after the aggregation (one per metric and comparison).
"""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship these helpers inside the serialised UDFs, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def normal_quantile(q: float) -> float:
    """Standard normal quantile of a plain number, used as a literal in expressions."""
    return NormalDist().inv_cdf(q)


def normal_tails(z: np.ndarray) -> np.ndarray:
    """P(|Z| >= |z|)."""
    return np.array([math.erfc(abs(v) / math.sqrt(2.0)) for v in z], dtype=float)


def chi2_tail(x: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """P(X >= x) for whole degrees of freedom, by the finite sums for even and odd dof."""
    return np.array([_chi2_tail_one(v, k) for v, k in zip(x, dof)], dtype=float)


def _chi2_tail_one(x: float, dof: float) -> float:
    if not (math.isfinite(x) and math.isfinite(dof)) or dof < 1:
        return math.nan
    if x <= 0:
        return 1.0
    half = x / 2.0
    power = 0.0 if int(dof) % 2 == 0 else 0.5
    total = 0.0 if power == 0.0 else math.erfc(math.sqrt(half))
    # Terms half**a * exp(-half) / gamma(a + 1); logarithms keep large arguments finite.
    while power < dof / 2.0:
        total += math.exp(power * math.log(half) - half - math.lgamma(power + 1.0))
        power += 1.0
    return min(1.0, total)


def log_gamma_step(a: np.ndarray) -> np.ndarray:
    """lgamma(a + 1/2) - lgamma(a) without the loss of digits of the difference.

    The recurrence lifts a by twenty, where the asymptotic series is exact to rounding.
    """
    a = np.asarray(a, dtype=float)
    lifted = sum(np.log1p(0.5 / (a + i)) for i in range(20))
    z = a + 20.0
    series = 0.5 * np.log(z) - 1 / (8 * z) + 1 / (192 * z**3) - 1 / (640 * z**5) + 17 / (14336 * z**7)
    return series - lifted


# Nodes of the exp-sinh rule for integrals over the positive half line.
_TAU = np.arange(-4.5, 3.75, 1 / 32)
_NODES = np.exp(np.pi / 2 * np.sinh(_TAU))
_WEIGHTS = np.pi / 64 * np.cosh(_TAU) * _NODES


def _log_cosh(s: np.ndarray) -> np.ndarray:
    small = np.minimum(s, 1.0)
    return np.where(
        s > 1.0, s + np.log1p(np.exp(-2.0 * s)) - math.log(2.0), np.log1p(2.0 * np.sinh(small / 2.0) ** 2)
    )


def t_tails(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|); dof need not be whole. One formula for every dof.

    With u = sqrt(dof) sinh(s) the density becomes a power of cosh(s), whose tail from
    asinh(|t| / sqrt(dof)) is summed by the exp-sinh rule on the scale on which it decays.
    """
    t, dof = np.asarray(t, dtype=float), np.asarray(dof, dtype=float)
    out = np.full(t.shape, np.nan)
    known = (dof > 0) & ~np.isnan(t)
    out[known] = 0.0
    ok = known & np.isfinite(t)
    v = dof[ok]
    start = np.arcsinh(np.abs(t[ok]) / np.sqrt(v))
    scale = 1.0 / (v * np.tanh(start) + np.sqrt(v))
    path = start[:, None] + scale[:, None] * _NODES
    decay = np.exp(-v[:, None] * (_log_cosh(path) - _log_cosh(start)[:, None]))
    area = scale * (decay * _WEIGHTS).sum(axis=1)
    level = np.exp(log_gamma_step(v / 2.0) - v * _log_cosh(start)) / math.sqrt(math.pi)
    out[ok] = np.minimum(1.0, 2.0 * level * area)
    return out


def _t_density(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    scale = np.exp(log_gamma_step(dof / 2.0)) / np.sqrt(dof * math.pi)
    return scale * np.exp(-(dof + 1.0) / 2.0 * np.log1p(t * t / dof))


def t_quantile(q: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Upper quantiles (q > 0.5) of the t distribution.

    Newton steps from the normal quantile, replaced by halving whenever a step leaves the
    bracket that is known to hold the answer.
    """
    q, dof = np.asarray(q, dtype=float), np.asarray(dof, dtype=float)
    out = np.full(q.shape, np.nan)
    ok = (dof > 0) & ~np.isnan(dof)
    target, dof = 2.0 * (1.0 - q[ok]), dof[ok]
    low, high = np.zeros(dof.shape), np.full(dof.shape, np.inf)
    t = np.array([normal_quantile(v) for v in q[ok]], dtype=float)
    for _ in range(200):
        excess = t_tails(t, dof) - target
        low, high = np.where(excess > 0, t, low), np.where(excess > 0, high, t)
        new = t + excess / (2.0 * _t_density(t, dof))
        outside = ~((new > low) & (new < high))
        middle = np.where(np.isinf(high), 2.0 * t + 1.0, (low + high) / 2.0)
        new = np.where(outside & (excess != 0), middle, np.where(excess == 0, t, new))
        moved, t = np.abs(new - t), new
        if np.all(moved <= 1e-13 * np.abs(t)):
            break
    out[ok] = t
    return out


def _nullable(values: np.ndarray) -> pd.Series:
    """NaN means "not defined" here and becomes null in Spark."""
    return pd.Series([None if math.isnan(v) else float(v) for v in values], dtype="object")


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _nullable(normal_tails(z.to_numpy(dtype=float)))


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _nullable(chi2_tail(x.to_numpy(dtype=float), dof.to_numpy(dtype=float)))


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _nullable(t_tails(t.to_numpy(dtype=float), dof.to_numpy(dtype=float)))


@F.pandas_udf(DoubleType())
def t_critical(q: pd.Series, dof: pd.Series) -> pd.Series:
    return _nullable(t_quantile(q.to_numpy(dtype=float), dof.to_numpy(dtype=float)))
