"""Poisson bootstrap of a ratio metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortwise.functions.columns import poisson_digest, poisson_from_hex, poisson_weight, ratio


def replicate_ratios(
    users: DataFrame, group: str, numerator: str, denominator: str, user: str,
    replicates: int = 2000, seed: int = 42, method: str = "xxhash64",
) -> DataFrame:
    """Weighted sums and their ratio per (replicate, group).

    Each user meets each replicate with a hash-derived Poisson(1) weight. The product of
    users and replicates exists only as a stream inside a task: partial sums leave it, at
    most groups x replicates rows. The users are spread evenly first, because every row
    turns into ``replicates`` rows of work; an adaptive plan would merge such small
    partitions into a few tasks.
    """
    parts = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    even = users.select(group, user, numerator, denominator).repartition(parts, user)
    if method == "md5":
        # One digest serves four replicates.
        blocks = even.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // 4))))
        drawn = (
            blocks.withColumn("_digest", poisson_digest(F.col(user), F.col("_block"), seed))
            .withColumn("_word", F.explode(F.sequence(F.lit(0), F.lit(3))))
            .withColumn("replicate", F.col("_block") * 4 + F.col("_word"))
            .where(F.col("replicate") < replicates)
        )
        weight = poisson_from_hex(F.substr("_digest", F.col("_word") * 8 + 1, F.lit(8)))
    else:
        drawn = even.withColumn(
            "replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1)))
        )
        weight = poisson_weight(F.col(user), F.col("replicate"), seed, method)
    return (
        drawn.withColumn("_w", weight)
        .groupBy("replicate", group)
        .agg(
            F.sum(F.col("_w") * F.col(numerator)).alias("weighted_numerator"),
            F.sum(F.col("_w") * F.col(denominator)).alias("weighted_denominator"),
        )
        .withColumn("value", ratio(F.col("weighted_numerator"), F.col("weighted_denominator")))
    )


def replicate_differences(ratios: DataFrame, group: str, control, test) -> DataFrame:
    """test - control per replicate."""
    def of(arm):
        return F.max(F.when(F.col(group) == arm, F.col("value")))

    return ratios.groupBy("replicate").agg((of(test) - of(control)).alias("difference"))


def bootstrap_summary(differences: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Mean, percentile interval and two-sided p of the replicate differences.

    One value per replicate, so the exact percentile is over a fixed number of rows.
    """
    low = (1 - confidence) / 2
    d = F.col("difference")
    smaller = F.least(F.count_if(d <= 0), F.count_if(d >= 0))
    return differences.where(d.isNotNull()).agg(
        F.count("*").alias("replicates"),
        F.avg(d).alias("mean_difference"),
        F.percentile(d, F.lit(low)).alias("ci_low"),
        F.percentile(d, F.lit(1 - low)).alias("ci_high"),
        F.least(F.lit(1.0), ratio(2 * (smaller + 1), F.count("*") + 1)).alias("p_value"),
    )


def poisson_bootstrap(
    users: DataFrame, group: str, control, test, numerator: str, denominator: str,
    user: str, replicates: int = 2000, seed: int = 42, method: str = "xxhash64",
    confidence: float = 0.95,
) -> DataFrame:
    """Bootstrap of the difference of a ratio. With a denominator of one it is a mean."""
    ratios = replicate_ratios(users, group, numerator, denominator, user, replicates, seed, method)
    return bootstrap_summary(replicate_differences(ratios, group, control, test), confidence)
