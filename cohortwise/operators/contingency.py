"""Chi-square tests from cell counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from cohortwise.functions.columns import flag_sum, ratio
from cohortwise.functions.distributions import chi2_p


def cell_counts(
    df: DataFrame, arm: str, arms: Sequence, features: Sequence[str]
) -> DataFrame:
    """Users per (feature, category) with one column ``arm_0, arm_1, ...`` per arm.

    Null categories and null arms do not take part.
    """
    text = df.select(arm, *[F.col(f).cast("string").alias(f) for f in features])
    long = text.where(F.col(arm).isin(list(arms))).unpivot([arm], list(features), "feature", "category")
    return long.where(F.col("category").isNotNull()).groupBy("feature", "category").agg(
        *[flag_sum(F.col(arm) == a).alias(f"arm_{i}") for i, a in enumerate(arms)]
    )


def chi2_statistic(cells: DataFrame, n_arms: int, correction: bool = True) -> DataFrame:
    """Per feature: chi-square and degrees of freedom; Yates only where dof is one.

    Margins of the arms are one row per feature; margins of the categories are the row sums.
    """
    names = [f"arm_{i}" for i in range(n_arms)]
    row_sum = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    margins = cells.groupBy("feature").agg(
        *[F.sum(c).alias(f"all_{c}") for c in names],
        F.sum(row_sum).alias("users"),
        F.count("*").alias("categories"),
    )
    arms_used = sum(
        ((F.col(f"all_{c}") > 0).cast("int") for c in names[1:]),
        (F.col(f"all_{names[0]}") > 0).cast("int"),
    )
    joined = cells.join(margins, "feature").withColumn("_row", row_sum)
    parts, gaps = [], []
    for c in names:
        expected = ratio(F.col("_row") * F.col(f"all_{c}"), F.col("users"))
        gap = F.col(c) - expected
        parts.append(F.coalesce(ratio(gap * gap, expected), F.lit(0.0)))
        gaps.append(F.abs(gap))
    reduced = joined.groupBy("feature").agg(
        F.max("users").alias("users"),
        F.sum(sum(parts[1:], parts[0])).alias("_plain"),
        # In a 2 x 2 table all four gaps are equal.
        F.max(F.greatest(*gaps) if len(gaps) > 1 else gaps[0]).alias("_gap"),
        F.max((F.col("categories") - 1) * (arms_used - 1)).cast("long").alias("dof"),
    )
    shrink = ratio(F.col("_gap") - F.least(F.lit(0.5), F.col("_gap")), F.col("_gap"))
    corrected = F.coalesce(F.col("_plain") * shrink * shrink, F.lit(0.0))
    use = (F.col("dof") == 1) & F.lit(correction)
    return reduced.select(
        "feature", "users", "dof", F.when(use, corrected).otherwise(F.col("_plain")).alias("chi2")
    )


def chi2_test(cells: DataFrame, n_arms: int, correction: bool = True) -> DataFrame:
    return chi2_statistic(cells, n_arms, correction).withColumn(
        "p_value", chi2_p("chi2", F.col("dof").cast("double"))
    )


def sample_ratio(df: DataFrame, arm: str, expected: Mapping[object, float]) -> DataFrame:
    """Sample-ratio mismatch: users per arm against the expected shares, chi-square and p."""
    total_share = float(sum(expected.values()))
    counts = df.where(F.col(arm).isin(list(expected))).agg(
        *[flag_sum(F.col(arm) == a).alias(f"n_{i}") for i, a in enumerate(expected)]
    )
    names = [f"n_{i}" for i in range(len(expected))]
    users = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    chi2 = F.lit(0.0)
    for name, share in zip(names, expected.values()):
        wanted = users * F.lit(share / total_share)
        chi2 = chi2 + ratio((F.col(name) - wanted) * (F.col(name) - wanted), wanted)
    return (
        counts.withColumn("users", users)
        .withColumn("chi2", chi2)
        .withColumn("dof", F.lit(len(names) - 1).cast("long"))
        .withColumn("p_value", chi2_p("chi2", F.col("dof").cast("double")))
    )
