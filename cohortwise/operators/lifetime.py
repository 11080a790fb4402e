"""Lifetimes cut off by the end of observation: survival, churn and lifetime value.

A user's life begins on the first day and is followed until the last day of the table. A user
who is silent for more than ``quiet`` days has left on the last active day; all others are
censored at the end. Days are whole, so everything after the first aggregate has one row per
group and day of age, however many users there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwise.functions.columns import ratio
from cohortwise.functions.distributions import normal_p


def lifetimes(
    events: DataFrame, keys: Sequence[str] = (), end: str | None = None, quiet: int = 7, user: str = "user_id",
) -> DataFrame:
    """Per user: keys, ``born``, ``age`` (days observed, or up to leaving), ``left``, ``seen`` days.

    ``keys`` do not change within a user. ``end`` is the last day of observation, by default
    the last day of the table. Rows without a user or a time have no part, days after ``end``
    neither.
    """
    day = F.to_date("time")
    last = events.agg(F.max(day)).scalar() if end is None else F.lit(end).cast("date")
    known = events.where(F.col(user).isNotNull() & F.col("time").isNotNull()).withColumn("_end", last)
    users = known.where(day <= F.col("_end")).groupBy(user, *keys).agg(
        F.min(day).alias("born"), F.max(day).alias("_last"), F.first("_end").alias("_end")
    )
    left = F.datediff("_end", "_last") > quiet
    return users.select(
        user, *keys, "born",
        F.when(left, F.datediff("_last", "born")).otherwise(F.datediff("_end", "born")).cast("long").alias("age"),
        left.alias("left"), F.datediff("_end", "born").cast("long").alias("seen"),
    )


def risk_sets(lives: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per group and age at which someone leaves or is censored: leavers, censored, at risk."""
    counts = lives.groupBy(*keys, "age").agg(
        F.count_if("left").alias("leavers"), F.count_if(~F.col("left")).alias("censored")
    )
    # One row per group and day: those at risk at an age are all that end there or later.
    later = W.partitionBy(*keys).orderBy(F.desc("age")).rowsBetween(W.unboundedPreceding, W.currentRow)
    return counts.withColumn("at_risk", F.sum(F.col("leavers") + F.col("censored")).over(later))


def survival(lives: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Kaplan-Meier survival per group and age, with its standard error by Greenwood's formula."""
    upto = W.partitionBy(*keys).orderBy("age").rowsBetween(W.unboundedPreceding, W.currentRow)
    d, n = F.col("leavers"), F.col("at_risk")
    everyone = F.max((d == n).cast("int")).over(upto) == 1
    logs = F.sum(F.when(d < n, F.log1p(-(d / n)))).over(upto)
    spread = F.sum(F.when(d < n, d / (n * (n - d)).cast("double"))).over(upto)
    out = risk_sets(lives, keys).select(
        *keys, "age", "at_risk", "leavers", "censored",
        F.when(everyone, F.lit(0.0)).otherwise(F.exp(F.coalesce(logs, F.lit(0.0)))).alias("survival"),
        F.coalesce(spread, F.lit(0.0)).alias("_spread"),
    )
    return out.withColumn("se", F.col("survival") * F.sqrt("_spread")).drop("_spread")


def log_rank(lives: DataFrame, arm: str, control: str, test: str) -> DataFrame:
    """Leavers of the test arm against those expected if both arms left alike: z and p, one row."""
    sets = risk_sets(lives.where(F.col(arm).isin(control, test)), [arm])
    # An arm keeps its risk set between the ages that it has rows for.
    wide = sets.groupBy("age").pivot(arm, [control, test]).agg(
        F.first("leavers").alias("d"), F.first("censored").alias("c"), F.first("at_risk").alias("n")
    )
    later = W.orderBy(F.desc("age")).rowsBetween(W.unboundedPreceding, W.currentRow)
    risk = lambda a: F.coalesce(F.max(f"`{a}_n`").over(later), F.lit(0))
    both = wide.select(
        F.coalesce(F.col(f"`{control}_d`"), F.lit(0)).alias("dc"), F.coalesce(F.col(f"`{test}_d`"), F.lit(0)).alias("dt"),
        risk(control).alias("nc"), risk(test).alias("nt"),
    )
    d, n = F.col("dc") + F.col("dt"), F.col("nc") + F.col("nt")
    expected = d * F.col("nt") / n
    variance = F.when(n > 1, d * (F.col("nt") / n) * (F.col("nc") / n) * (n - d) / (n - 1)).otherwise(0.0)
    sums = both.agg(
        F.sum("dt").alias("observed"), F.sum(expected).alias("expected"), F.sum(variance).alias("variance")
    )
    z = ratio(F.col("observed") - F.col("expected"), F.sqrt("variance"))
    return sums.withColumn("z", z).withColumn("p_value", normal_p("z"))


def lifetime_value(
    lives: DataFrame, revenue: DataFrame, horizons: Sequence[int], keys: Sequence[str] = (), user: str = "user_id",
) -> DataFrame:
    """Mean revenue per user up to each age, weighted for censoring, with its standard error.

    ``revenue`` has ``user, time, value``. Revenue at an age is weighted by the users of the
    group over those who are observed at that age, so young users bias nothing. A horizon that
    no user of the group is observed for is null. Revenue before a user's first day or after
    the observation does not count; users without revenue stay in every mean.
    """
    if not keys:
        one = lifetime_value(lives.withColumn("_all", F.lit(1)), revenue, horizons, ["_all"], user)
        return one.drop("_all")
    top = max(horizons)
    ages = lives.groupBy(*keys, F.least("seen", F.lit(top)).alias("age")).agg(F.count("*").alias("n"))
    grid = ages.select(*keys).distinct().select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(top).cast("long"))).alias("age"))
    # One row per group and day of age from here on.
    later = W.partitionBy(*keys).orderBy(F.desc("age")).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*keys)
    filled = ages.withColumn("n", F.col("n")).unionByName(grid.withColumn("n", F.lit(0).cast("long"))).groupBy(*keys, "age").agg(F.sum("n").alias("n"))
    observed = filled.select(
        *keys, "age", F.sum("n").over(later).alias("observed"), F.sum("n").over(whole).alias("users"),
    )
    weights = observed.select(
        *keys, "age", "observed", "users", ratio(F.col("users"), F.col("observed")).alias("weight")
    )
    paid = revenue.groupBy(user, F.to_date("time").alias("day")).agg(F.sum("value").alias("value"))
    dated = lives.select(user, *keys, "born", "seen").join(paid, user).withColumn(
        "age", F.datediff("day", "born").cast("long")
    ).where((F.col("age") >= 0) & (F.col("age") <= F.least("seen", F.lit(top))))
    weighted = dated.join(weights.select(*keys, "age", "weight"), [*keys, "age"])
    upto = lambda h: F.coalesce(F.sum(F.when(F.col("age") <= h, F.col("value") * F.col("weight"))), F.lit(0.0))
    per_user = weighted.groupBy(user, *keys).agg(*[upto(h).alias(f"v{h}") for h in horizons])
    sums = per_user.groupBy(*keys).agg(*[
        f(c).alias(f"{name}{h}") for h in horizons
        for f, name, c in ((F.sum, "s", F.col(f"v{h}")), (F.sum, "q", F.col(f"v{h}") * F.col(f"v{h}")))
    ])
    sizes = weights.groupBy(*keys).agg(F.first("users").alias("users"), *[
        F.max(F.when(F.col("age") == h, F.col("observed"))).alias(f"o{h}") for h in horizons
    ])
    joined = sizes.join(sums, list(keys), "left")
    value = lambda h, c: F.coalesce(F.col(f"{c}{h}"), F.lit(0.0))
    n = F.col("users").cast("double")

    def row(h: int) -> Column:
        mean = value(h, "s") / n
        variance = F.greatest((value(h, "q") - n * mean * mean) / (n - 1), F.lit(0.0))
        known = F.col(f"o{h}") > 0
        return F.struct(
            F.lit(h).cast("long").alias("day"), F.col("users"), F.col(f"o{h}").alias("observed"),
            F.when(known, mean).alias("ltv"), F.when(known & (n > 1), F.sqrt(variance / n)).alias("se"),
        )

    return joined.select(*keys, F.inline(F.array(*[row(h) for h in horizons])))
