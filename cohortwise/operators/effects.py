"""Comparison of two arms from sufficient statistics.

One aggregate reduces the users to n, mean and variance per (segment, metric, arm).
Everything after that works on those few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.functions.columns import ratio
from cohortwise.functions.distributions import normal_p, normal_quantile, t_critical, t_p


def summarise(
    df: DataFrame, arm: str, metrics: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """n, mean, sample variance and total per (keys, metric, arm).

    A metric is null where the user does not count, for example revenue of non-payers in
    ARPPU. All metrics are computed in one pass; rows are not copied per metric.
    """
    def reduced(name: str, value: Column) -> Column:
        number = value.cast("double")
        return F.struct(
            F.lit(name).alias("metric"),
            F.count(number).alias("n"),
            F.avg(number).alias("mean"),
            F.var_samp(number).alias("var"),
            F.coalesce(F.sum(number), F.lit(0.0)).alias("total"),
        )

    packed = df.where(F.col(arm).isNotNull()).groupBy(*keys, arm).agg(
        F.array(*[reduced(name, value) for name, value in metrics.items()]).alias("_m")
    )
    return packed.select(*keys, arm, F.inline("_m"))


def pair(
    summary: DataFrame, arm: str, control, test, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per (keys, metric) with the statistics of both arms side by side."""
    def of(group, column: str) -> Column:
        return F.max(F.when(F.col(arm) == group, F.col(column)))

    columns = []
    for suffix, group in (("c", control), ("t", test)):
        columns += [of(group, c).alias(f"{c}_{suffix}") for c in ("n", "mean", "var", "total")]
    return summary.groupBy(*keys, "metric").agg(*columns)


def welch_statistic(pairs: DataFrame) -> DataFrame:
    """Difference test - control, standard error, t and Welch-Satterthwaite degrees of freedom."""
    a = ratio(F.col("var_c"), F.col("n_c"))
    b = ratio(F.col("var_t"), F.col("n_t"))
    dof = ratio(
        (a + b) * (a + b),
        ratio(a * a, F.col("n_c") - 1) + ratio(b * b, F.col("n_t") - 1),
    )
    return (
        pairs.withColumn("diff", F.col("mean_t") - F.col("mean_c"))
        .withColumn("se", F.sqrt(a + b))
        .withColumn("t", ratio(F.col("diff"), F.col("se")))
        .withColumn("dof", dof)
    )


def welch_test(pairs: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Welch t-test of the means: two-sided p and interval of the difference."""
    upper = F.lit(0.5 + confidence / 2.0)
    margin = t_critical(upper, F.col("dof")) * F.col("se")
    return (
        welch_statistic(pairs)
        .withColumn("p_value", t_p("t", "dof"))
        .withColumn("_margin", margin)
        .withColumn("ci_low", F.col("diff") - F.col("_margin"))
        .withColumn("ci_high", F.col("diff") + F.col("_margin"))
        .drop("_margin")
    )


def proportion_z(pairs: DataFrame) -> DataFrame:
    """z of two proportions with pooled variance; the metrics are 0/1."""
    pooled = ratio(F.col("total_c") + F.col("total_t"), F.col("n_c") + F.col("n_t"))
    weights = ratio(F.lit(1.0), F.col("n_c")) + ratio(F.lit(1.0), F.col("n_t"))
    return (
        pairs.withColumn("diff", F.col("mean_t") - F.col("mean_c"))
        .withColumn("z", ratio(F.col("diff"), F.sqrt(pooled * (1 - pooled) * weights)))
    )


def proportion_test(pairs: DataFrame) -> DataFrame:
    return proportion_z(pairs).withColumn("p_value", normal_p("z"))


def _wilson(share: Column, n: Column, z: float) -> tuple[Column, Column]:
    centre = share + z * z / (2 * n)
    spread = z * F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    scale = 1 + z * z / n
    return (centre - spread) / scale, (centre + spread) / scale


def proportion_intervals(pairs: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Wald (unpooled) and Newcombe (from two Wilson intervals) limits of test - control."""
    z = normal_quantile(0.5 + confidence / 2.0)
    # Doubles throughout; a missing arm gives null, not a division error.
    n_c, n_t = (F.nullif(F.col(c).cast("double"), F.lit(0.0)) for c in ("n_c", "n_t"))
    p_c, p_t = F.col("mean_c"), F.col("mean_t")
    diff = p_t - p_c
    wald = z * F.sqrt(p_c * (1 - p_c) / n_c + p_t * (1 - p_t) / n_t)
    low_c, high_c = _wilson(p_c, n_c, z)
    low_t, high_t = _wilson(p_t, n_t, z)
    below = F.sqrt((p_t - low_t) * (p_t - low_t) + (high_c - p_c) * (high_c - p_c))
    above = F.sqrt((high_t - p_t) * (high_t - p_t) + (p_c - low_c) * (p_c - low_c))
    return pairs.select(
        "*",
        diff.alias("diff"),
        (diff - wald).alias("wald_low"),
        (diff + wald).alias("wald_high"),
        (diff - below).alias("newcombe_low"),
        (diff + above).alias("newcombe_high"),
    )


def effect_table(
    pairs: DataFrame, proportions: Sequence[str], keys: Sequence[str] = (),
    alpha: float = 0.05,
) -> DataFrame:
    """Control, test, absolute and relative effect, p, verdict and interval per metric.

    Metrics in ``proportions`` are shown in percent, tested by z and given the Wald interval;
    the others are means with the Welch test and interval.
    """
    is_share = F.col("metric").isin(list(proportions))
    columns = [
        *keys, "metric", "n_c", "n_t", "mean_c", "mean_t", "p_value", "ci_low", "ci_high", "scale",
    ]
    shares = (
        proportion_intervals(proportion_test(pairs.where(is_share)).drop("diff"), 1 - alpha)
        .withColumn("ci_low", F.col("wald_low"))
        .withColumn("ci_high", F.col("wald_high"))
        .withColumn("scale", F.lit(100.0))
        .select(*columns)
    )
    means = welch_test(pairs.where(~is_share), 1 - alpha).withColumn("scale", F.lit(1.0))
    both = shares.unionByName(means.select(*columns))
    scale = F.col("scale")
    return both.select(
        *keys,
        "metric",
        (F.col("mean_c") * scale).alias("control"),
        (F.col("mean_t") * scale).alias("test"),
        ((F.col("mean_t") - F.col("mean_c")) * scale).alias("absolute_effect"),
        ((ratio(F.col("mean_t"), F.col("mean_c")) - 1) * 100).alias("relative_effect_pct"),
        "p_value",
        (F.col("p_value") < alpha).alias("significant"),
        (F.col("ci_low") * scale).alias("ci_low"),
        (F.col("ci_high") * scale).alias("ci_high"),
    )


def detectable_effect(
    pairs: DataFrame, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """Smallest effect the sizes can show, and users per arm needed for a 5 % relative one."""
    z = normal_quantile(1 - alpha / 2.0) + normal_quantile(power)
    spread = ratio(F.col("var_c"), F.col("n_c")) + ratio(F.col("var_t"), F.col("n_t"))
    target = 0.05 * F.col("mean_c")
    return pairs.select(
        "*",
        (z * F.sqrt(spread)).alias("mde"),
        (ratio(z * F.sqrt(spread), F.col("mean_c")) * 100).alias("mde_pct"),
        F.ceil(
            ratio(z * z * (F.col("var_c") + F.col("var_t")), target * target)
        ).alias("n_per_arm_5pct"),
    )


def stratified_effect(pairs: DataFrame, stratum: str) -> DataFrame:
    """Differences per stratum averaged with the stratum sizes as weights, with z and p."""
    by_stratum = welch_statistic(pairs).withColumn(
        "_size", (F.col("n_c") + F.col("n_t")).cast("double")
    )
    reduced = by_stratum.where(F.col(stratum).isNotNull()).groupBy("metric").agg(
        F.count("*").alias("strata"),
        ratio(F.sum(F.col("_size") * F.col("diff")), F.sum("_size")).alias("diff"),
        ratio(
            F.sqrt(F.sum(F.pow(F.col("_size") * F.col("se"), 2.0))), F.sum("_size")
        ).alias("se"),
    )
    return reduced.withColumn("z", ratio(F.col("diff"), F.col("se"))).withColumn(
        "p_value", normal_p("z")
    )


def difference_in_differences(
    df: DataFrame, arm: str, control, test, post: str, metrics: Mapping[str, Column]
) -> DataFrame:
    """(test after - before) - (control after - before) with its standard error.

    ``post`` is a boolean column; a row is a user in a period.
    """
    summary = summarise(df, arm, metrics, [post])
    wide = pair(summary, arm, control, test, [post])
    change = F.col("mean_t") - F.col("mean_c")
    square = ratio(F.col("var_t"), F.col("n_t")) + ratio(F.col("var_c"), F.col("n_c"))
    after = F.col(post)
    reduced = wide.groupBy("metric").agg(
        F.max(F.when(~after, change)).alias("gap_before"),
        F.max(F.when(after, change)).alias("gap_after"),
        F.sqrt(F.sum(square)).alias("se"),
    )
    return (
        reduced.withColumn("effect", F.col("gap_after") - F.col("gap_before"))
        .withColumn("z", ratio(F.col("effect"), F.col("se")))
        .withColumn("p_value", normal_p("z"))
    )
