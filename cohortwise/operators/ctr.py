"""Click-through rate of users, groups and hash buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortwise.functions.columns import flag_sum, hash_bucket, in_period, ratio
from cohortwise.operators.ordering import exact_quantiles, interpolated, running_counts


def user_ctr(
    actions: DataFrame, start=None, end=None, groups: Sequence[int] | None = None,
    like: str = "like", view: str = "view",
) -> DataFrame:
    """Likes, views and their ratio per (group, user) in a day range; null without views."""
    chosen = actions.where(in_period(F.col("time"), start, end))
    if groups is not None:
        chosen = chosen.where(F.col("exp_group").isin(list(groups)))
    return (
        chosen.groupBy("exp_group", "user_id")
        .agg(
            flag_sum(F.col("action") == like).alias("likes"),
            flag_sum(F.col("action") == view).alias("views"),
        )
        .withColumn("ctr", ratio(F.col("likes"), F.col("views")))
    )


def ctr_summary(users: DataFrame) -> DataFrame:
    """Per group: users, likes, views, mean and median user CTR, global CTR."""
    totals = users.groupBy("exp_group").agg(
        F.count("*").alias("users"),
        F.sum("likes").alias("likes"),
        F.sum("views").alias("views"),
        F.avg("ctr").alias("mean_user_ctr"),
    )
    medians = exact_quantiles(users, ["exp_group"], "ctr", {"median_user_ctr": 0.5})
    return totals.join(medians, "exp_group", "left").withColumn(
        "global_ctr", ratio(F.col("likes"), F.col("views"))
    )


def ctr_effect(users: DataFrame, control: int, test: int) -> DataFrame:
    """Global CTR of both groups, absolute and relative difference: one row."""
    def rate(group: int):
        member = F.col("exp_group") == group
        return ratio(F.sum(F.when(member, F.col("likes"))), F.sum(F.when(member, F.col("views"))))

    reduced = users.agg(rate(control).alias("control_ctr"), rate(test).alias("test_ctr"))
    return reduced.select(
        "*",
        (F.col("test_ctr") - F.col("control_ctr")).alias("absolute_effect"),
        (ratio(F.col("test_ctr"), F.col("control_ctr")) - 1).alias("relative_effect"),
    )


def ctr_distribution(users: DataFrame, low: float = 0.10, high: float = 0.30) -> DataFrame:
    """Per group: users, mean, sample deviation, median, shares outside [low, high]."""
    ctr = F.col("ctr")
    moments = users.groupBy("exp_group").agg(
        F.count("ctr").alias("users"),
        F.avg("ctr").alias("mean"),
        F.stddev_samp("ctr").alias("std"),
        F.avg((ctr < low).cast("double")).alias("share_below"),
        F.avg((ctr > high).cast("double")).alias("share_above"),
    )
    return moments.join(exact_quantiles(users, ["exp_group"], "ctr", {"median": 0.5}), "exp_group")


def smoothed_ctr(users: DataFrame, alpha: float = 5.0) -> DataFrame:
    """Add ``smoothed_ctr``: user CTR pulled to the pooled rate by ``alpha`` pseudo-views.

    The pooled rate is one number; as a scalar subquery it needs no join.
    """
    pooled = users.agg(ratio(F.sum("likes"), F.sum("views")).alias("rate")).scalar()
    return users.withColumn("pooled_ctr", pooled).withColumn(
        "smoothed_ctr",
        ratio(F.col("likes") + alpha * F.col("pooled_ctr"), F.col("views") + F.lit(alpha)),
    )


def bucket_ctr(
    users: DataFrame, buckets: int = 50, q: float = 0.9, method: str = "xxhash64"
) -> DataFrame:
    """Per (group, hash bucket): pooled CTR and the exact user-CTR quantile at index floor(q * n)."""
    keyed = users.withColumn("bucket", hash_bucket(F.col("user_id"), buckets, method))
    keys = ["exp_group", "bucket"]
    rates = keyed.groupBy(*keys).agg(
        F.count("*").alias("users"),
        ratio(F.sum("likes"), F.sum("views")).alias("bucket_ctr"),
    )
    return rates.join(
        exact_quantiles(keyed, keys, "ctr", {"ctr9": q}, by_index=True), keys, "left"
    )


def bucket_summary(buckets: DataFrame) -> DataFrame:
    """Per group: number of buckets, mean and median bucket CTR."""
    moments = buckets.groupBy("exp_group").agg(
        F.count("*").alias("buckets"), F.avg("bucket_ctr").alias("mean_bucket_ctr")
    )
    counted = running_counts(buckets, ["exp_group"], "bucket_ctr", slices=1)
    medians = counted.groupBy("exp_group").agg(
        interpolated("bucket_ctr", 0.5).alias("median_bucket_ctr")
    )
    return moments.join(medians, "exp_group")
