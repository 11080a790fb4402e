"""How much a few large payers decide: tail index and the mean without the largest ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from cohortwise.functions.columns import ratio


def tail_check(
    users: DataFrame, group: str, revenue: str, removed: Sequence[int] = (0, 1, 5, 10, 50, 100),
) -> DataFrame:
    """Per group and number of largest payers removed: their revenue share, the mean revenue of
    the users left, and Hill's tail index of the payers removed.

    One aggregate, and the largest ``max(removed) + 1`` payers of a group, which every task
    cuts down to before the shuffle. Hill's index is one over the mean log of the removed
    payers' revenue over the next one's; it is null without such a payer or where all are
    equal. A number of payers the group does not have gives null. Users without revenue count.
    """
    known = users.where(F.col(group).isNotNull()).select(
        group, F.coalesce(F.col(revenue).cast("double"), F.lit(0.0)).alias("x")
    )
    totals = known.groupBy(group).agg(
        F.count("*").alias("users"), F.sum("x").alias("total"), F.count_if(F.col("x") > 0).alias("payers")
    )
    top = W.partitionBy(group).orderBy(F.desc("x"))
    largest = known.where("x > 0").withColumn("rank", F.row_number().over(top)).where(
        F.col("rank") <= max(removed) + 1
    )
    lists = largest.groupBy(group).agg(F.reverse(F.array_sort(F.collect_list("x"))).alias("top"))
    counted = totals.join(lists, group, "left").withColumn(
        "removed", F.explode(F.array(*[F.lit(k).cast("long") for k in removed]))
    ).withColumn("top", F.coalesce("top", F.array().cast("array<double>")))
    k = F.col("removed").cast("int")
    gone = F.slice("top", F.lit(1), k)
    sum_of = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    next_one = F.get("top", k)
    logs = sum_of(F.transform(gone, lambda x: F.log(x / next_one)))
    enough = F.col("payers") >= F.col("removed")
    hill = F.when(next_one.isNotNull() & (k > 0), ratio(F.col("removed").cast("double"), logs))
    return counted.select(
        group, "removed", "users", "payers",
        F.when(enough, ratio(sum_of(gone), F.col("total"))).alias("removed_share"),
        F.when(enough, ratio(F.col("total") - sum_of(gone), F.col("users") - F.col("removed"))).alias("mean_left"),
        F.when(enough, hill).alias("hill_index"),
    )


def tail_effect(checks: DataFrame, group: str, control: str, test: str) -> DataFrame:
    """Difference of the means of two groups for each number of payers removed from both."""
    means = checks.groupBy("removed").pivot(group, [control, test]).agg(F.first("mean_left"))
    a, b = F.col(f"`{control}`"), F.col(f"`{test}`")
    return means.select(
        "removed", a.alias("mean_control"), b.alias("mean_test"), (b - a).alias("effect"),
        (ratio(b - a, a) * 100).alias("effect_pct"),
    )
