"""Kruskal-Wallis and Mann-Whitney on distributed mid-ranks."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from cohortwise.functions.columns import flag_sum, ratio
from cohortwise.functions.distributions import chi2_p, normal_p
from cohortwise.operators.ordering import running_counts

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def unpivot_metrics(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Long form ``ids..., metric, value`` of several numeric columns."""
    wide = df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot(list(ids), list(metrics), "metric", "value")


def rank_sums(
    long: DataFrame, arm: str, arms: Sequence, keys: Sequence[str] = ("metric",),
    value: str = "value", slices: int | None = None,
) -> DataFrame:
    """Per key: users, tie term sum(t^3 - t), and per arm its size and sum of mid-ranks."""
    chosen = long.where(F.col(arm).isin(list(arms)))
    sizes = {f"_arm_{i}": flag_sum(F.col(arm) == a) for i, a in enumerate(arms)}
    counted = running_counts(chosen, keys, value, sizes, slices)
    n = F.col("n").cast("double")
    middle = F.col("running") - (n - 1) / 2
    aggregates = [F.max("total").alias("users"), F.sum(n * n * n - n).alias("ties")]
    for i in range(len(arms)):
        size = F.col(f"_arm_{i}")
        aggregates += [F.sum(size).alias(f"n_{i}"), F.sum(middle * size).alias(f"rank_sum_{i}")]
    return counted.groupBy(*keys).agg(*aggregates)


def kruskal_statistic(sums: DataFrame, n_arms: int) -> DataFrame:
    """H with tie correction and its degrees of freedom."""
    total = F.col("users").cast("double")
    squares = F.lit(0.0)
    for i in range(n_arms):
        squares = squares + ratio(F.pow(F.col(f"rank_sum_{i}"), F.lit(2.0)), F.col(f"n_{i}"))
    plain = ratio(12 * squares, total * (total + 1)) - 3 * (total + 1)
    correction = 1 - ratio(F.col("ties"), total * total * total - total)
    # Rounding can leave a tiny negative number where the groups are equal.
    return sums.withColumn("h", F.greatest(ratio(plain, correction), F.lit(0.0))).withColumn(
        "dof", F.lit(n_arms - 1).cast("long")
    )


def kruskal_test(sums: DataFrame, n_arms: int) -> DataFrame:
    return kruskal_statistic(sums, n_arms).withColumn(
        "p_value", chi2_p("h", F.col("dof").cast("double"))
    )


def mann_whitney_statistic(sums: DataFrame) -> DataFrame:
    """U of the first arm and its z with tie and continuity correction."""
    n0, n1 = F.col("n_0").cast("double"), F.col("n_1").cast("double")
    total = n0 + n1
    u = F.col("rank_sum_0") - n0 * (n0 + 1) / 2
    larger = F.greatest(F.col("u"), n0 * n1 - F.col("u"))
    variance = n0 * n1 / 12 * (total + 1 - ratio(F.col("ties"), total * (total - 1)))
    z = ratio(larger - n0 * n1 / 2 - 0.5, F.sqrt(variance))
    return sums.withColumn("u", u).withColumn("z", z)


def mann_whitney_test(sums: DataFrame) -> DataFrame:
    """Two-sided asymptotic test. A negative z (U at its centre) gives p = 1."""
    return mann_whitney_statistic(sums).withColumn(
        "p_value", F.when(F.col("z") <= 0, 1.0).otherwise(normal_p("z"))
    )


#: Largest sample that the exact test takes.
SMALL = 200


def _exact_p(sizes: Sequence[int], middles: Sequence[float], chosen: int, rank_sum: float) -> float:
    """Share of the choices of ``chosen`` values whose rank sum is as far from the middle.

    The number of choices for each count and doubled rank sum grows value by value; equal
    values share their mid-rank.
    """
    doubled = [int(round(2 * m)) for m, n in zip(middles, sizes) for _ in range(n)]
    ways = np.zeros((chosen + 1, sum(doubled) + 1))
    ways[0, 0] = 1.0
    for r in doubled:
        ways[1:, r:] += ways[:-1, :ways.shape[1] - r]
    last = ways[chosen]
    far = np.abs(np.arange(len(last)) * len(doubled) - chosen * sum(doubled))
    seen = abs(int(round(2 * rank_sum)) * len(doubled) - chosen * sum(doubled))
    return float(min(1.0, last[far >= seen].sum() / last.sum()))


@F.pandas_udf(DoubleType())
def exact_p(values: pd.Series, chosen: pd.Series, rank_sum: pd.Series) -> pd.Series:
    """Exact p-values; null where a sample is too large or an arm is empty."""
    out = []
    for rows, k, r in zip(values, chosen, rank_sum):
        total = sum(x["n"] for x in rows)
        usable = len(rows) and 0 < k < total
        out.append(_exact_p([x["n"] for x in rows], [x["middle"] for x in rows], int(k), r) if usable else None)
    return pd.Series(out, dtype="object")


def mann_whitney_exact(
    long: DataFrame, arm: str, arms: Sequence, keys: Sequence[str] = ("metric",), value: str = "value",
    largest: int = SMALL, slices: int | None = None,
) -> DataFrame:
    """Two-sided exact Mann-Whitney test per key, ties included, for samples up to ``largest``.

    The p-value counts all ways to deal the ranks to the arms. Larger samples have a null
    p-value - :func:`mann_whitney_test` is for them - and their values are not gathered. With an
    empty arm there is no U.
    """
    first = flag_sum(F.col(arm) == arms[0])
    counted = running_counts(long.where(F.col(arm).isin(list(arms))), keys, value, {"_first": first}, slices)
    middle = F.col("running") - (F.col("n").cast("double") - 1) / 2
    few = F.when(F.col("total") <= largest, F.struct(middle.alias("middle"), "n"))
    sums = counted.groupBy(*keys).agg(
        F.sum("_first").alias("n_0"), (F.max("total") - F.sum("_first")).alias("n_1"),
        F.sum(middle * F.col("_first")).alias("rank_sum"), F.sort_array(F.collect_list(few)).alias("values"),
    )
    n0 = F.col("n_0").cast("double")
    both = (F.col("n_0") > 0) & (F.col("n_1") > 0)
    return sums.select(
        *keys, "n_0", "n_1", F.when(both, F.col("rank_sum") - n0 * (n0 + 1) / 2).alias("u"),
        exact_p("values", "n_0", "rank_sum").alias("p_value"),
    )
