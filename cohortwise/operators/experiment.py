"""User-level experiment tables and CR / ARPU / ARPPU metrics.

The unit of analysis is the user: payments are summed to the user before any join, and
users who never paid stay in the table with zeros.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.functions.columns import flag_sum, ratio, recode, round_half_even
from cohortwise.operators.ordering import exact_quantiles
from cohortwise.session import materialised
from cohortwise.sources import schemas
from cohortwise.sources.readers import read_by_position, read_delimited

# Product types of the price experiment.
PREMIUM, TRIAL = "premium_no_trial", "trial_premium"
POOLED_CONTROL = {"control_1": "control", "control_2": "control"}


def latest_assignment(
    batches: Sequence[DataFrame], user: str = "student_id", group: str = "grp",
    order: str | None = None,
) -> DataFrame:
    """One group per user: the last batch that names the user wins.

    Rows of a table have no order, so the batch number takes the place of the file order;
    ``order`` names a column that decides inside one batch. An aggregate with partial
    combine, no sort per user.
    """
    ranked = None
    for number, batch in enumerate(batches):
        rank = F.struct(F.lit(number).alias("batch"), F.col(order or group).alias("inside"))
        part = batch.select(user, group, rank.alias("_rank"))
        ranked = part if ranked is None else ranked.unionByName(part)
    return ranked.groupBy(user).agg(F.max_by(group, "_rank").alias(group))


def user_table(
    population: DataFrame, assignment: DataFrame, payments: DataFrame,
    user: str = "student_id", revenue: str = "rev",
) -> DataFrame:
    """Population with group and revenue; zero for users without a payment."""
    paid = payments.groupBy(user).agg(F.sum(revenue).alias(revenue))
    return (
        population.join(assignment, user, "left")
        .join(paid, user, "left")
        .withColumn(revenue, F.coalesce(revenue, F.lit(0.0)))
        .withColumn("payer", F.col(revenue) > 0)
    )


def group_metrics(users: DataFrame, group: str, revenue: str, keys: Sequence[str] = ()) -> DataFrame:
    """Users, payers, revenue, CR, ARPU and ARPPU; input has one row per user."""
    return (
        users.where(F.col(group).isNotNull())
        .groupBy(*keys, group)
        .agg(
            F.count("*").alias("users"),
            flag_sum(F.col(revenue) > 0).alias("payers"),
            F.coalesce(F.sum(revenue), F.lit(0.0)).alias("revenue"),
        )
        .withColumn("cr", ratio(F.col("payers"), F.col("users")))
        .withColumn("arpu", ratio(F.col("revenue"), F.col("users")))
        .withColumn("arppu", ratio(F.col("revenue"), F.col("payers")))
    )


def recalculate_metrics(
    groups: DataFrame, groups_add: DataFrame, active: DataFrame, checks: DataFrame
) -> DataFrame:
    """Metrics after a late batch of assignments; a later assignment replaces an earlier one."""
    assignment = latest_assignment([groups, groups_add])
    return group_metrics(user_table(active, assignment, checks), "grp", "rev")


def recalculate_from_files(
    spark: SparkSession, groups: str, groups_add: str, active: str, checks: str
) -> DataFrame:
    """The same from four paths; the header of the late file may differ."""
    return recalculate_metrics(
        read_by_position(spark, groups, schemas.GROUPS, ";"),
        read_by_position(spark, groups_add, schemas.GROUPS, ","),
        read_delimited(spark, active, schemas.POPULATION),
        read_delimited(spark, checks, schemas.CHECKS),
    )


def valid_transactions(transactions: DataFrame, ids: Sequence[str] = ("uid",)) -> DataFrame:
    """Rows that name a user, with whole-number ids. Repeated rows stay: they may be real."""
    kept = transactions.dropna(subset=["uid"])
    for column in ids:
        kept = kept.withColumn(column, F.col(column).cast("long"))
    return kept


def product_user_table(
    users: DataFrame, transactions: DataFrame, group: str = "group", user: str = "uid",
    premium: str = PREMIUM, trial: str = TRIAL,
) -> DataFrame:
    """Users with premium revenue, premium purchases and trial flag, in one pass over purchases."""
    product = F.col("product_type")
    bought = transactions.groupBy(group, user).agg(
        F.sum(F.when(product == premium, F.col("revenue"))).alias("premium_revenue"),
        flag_sum(product == premium).alias("premium_transactions"),
        F.max(product == trial).alias("trial_buyer"),
    )
    return (
        users.join(bought, [group, user], "left")
        .withColumn("premium_revenue", F.coalesce("premium_revenue", F.lit(0.0)))
        .withColumn("premium_transactions", F.coalesce("premium_transactions", F.lit(0)))
        .withColumn("payer", F.coalesce(F.col("total_revenue") > 0, F.lit(False)))
        .withColumn("premium_buyer", F.col("premium_revenue") > 0)
        .withColumn("trial_buyer", F.coalesce("trial_buyer", F.lit(False)))
    )


def product_metrics(users: DataFrame, group: str = "group") -> DataFrame:
    """Metrics of the whole shop and of premium, and the trial conversion as a placebo."""
    reduced = users.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("users"),
        F.count_if("payer").alias("payers"),
        F.sum("total_revenue").alias("revenue"),
        F.count_if("premium_buyer").alias("premium_buyers"),
        F.sum("premium_revenue").alias("premium_revenue"),
        F.count_if("trial_buyer").alias("trial_buyers"),
    )
    rates = {
        "conversion": ("payers", "users"),
        "arpu": ("revenue", "users"),
        "arppu": ("revenue", "payers"),
        "premium_conversion": ("premium_buyers", "users"),
        "premium_arpu": ("premium_revenue", "users"),
        "premium_arppu": ("premium_revenue", "premium_buyers"),
        "trial_conversion": ("trial_buyers", "users"),
    }
    return reduced.select(
        "*", *[ratio(F.col(a), F.col(b)).alias(name) for name, (a, b) in rates.items()]
    )


def pooled(users: DataFrame, group: str = "group", mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Add ``comparison``: the groups after merging the controls."""
    return users.withColumn(
        "comparison", recode(F.col(group), dict(mapping or POOLED_CONTROL))
    )


def large_payers(users: DataFrame, group: str, revenue: str, threshold: float) -> DataFrame:
    """Payers at or above a threshold: their number and their share of payers and revenue."""
    paid, large = F.col(revenue) > 0, F.col(revenue) >= threshold
    return users.where(F.col(group).isNotNull()).groupBy(group).agg(
        flag_sum(paid).alias("payers"),
        flag_sum(large).alias("large_payers"),
        ratio(flag_sum(large), flag_sum(paid)).alias("payer_share"),
        ratio(
            F.coalesce(F.sum(F.when(large, F.col(revenue))), F.lit(0.0)),
            F.sum(F.when(paid, F.col(revenue))),
        ).alias("revenue_share"),
    )


def payment_spike(users: DataFrame, group: str, revenue: str, amount: float) -> DataFrame:
    """Payers whose amount rounds (ties to even) to ``amount``, and their share of payers."""
    paid = F.col(revenue) > 0
    at_spike = paid & (round_half_even(F.col(revenue)) == amount)
    return users.where(F.col(group).isNotNull()).groupBy(group).agg(
        flag_sum(paid).alias("payers"),
        flag_sum(at_spike).alias("spike_payers"),
        ratio(flag_sum(at_spike), flag_sum(paid)).alias("spike_share"),
    )


def payer_statistics(users: DataFrame, group: str, revenue: str) -> DataFrame:
    """Count, mean, median, smallest and largest payment of the payers."""
    paid = users.where((F.col(revenue) > 0) & F.col(group).isNotNull())
    moments = paid.groupBy(group).agg(
        F.count("*").alias("payers"),
        F.avg(revenue).alias("mean"),
        F.min(revenue).alias("min"),
        F.max(revenue).alias("max"),
    )
    return moments.join(exact_quantiles(paid, [group], revenue, {"median": 0.5}), group)


def price_by(transactions: DataFrame, keys: Sequence[str], user: str = "uid", revenue: str = "revenue") -> DataFrame:
    """Purchases, distinct buyers, median and mean price per key."""
    # Rows of one buyer and price are counted once; the source is read for nothing else.
    prices = materialised(
        transactions.dropna(subset=list(keys)).groupBy(*keys, user, revenue).agg(F.count("*").alias("n"))
    )
    buyers = prices.groupBy(*keys, user).agg(
        F.sum("n").alias("n"), F.sum(F.col(revenue) * F.col("n")).alias("s"),
        F.sum(F.when(F.col(revenue).isNotNull(), F.col("n"))).alias("k"),
    )
    reduced = buyers.groupBy(*keys).agg(
        F.sum("n").alias("purchases"),
        F.count(user).alias("buyers"),
        ratio(F.sum("s"), F.sum("k")).alias("mean_revenue"),
    )
    medians = exact_quantiles(prices, keys, revenue, {"median_revenue": 0.5}, weight="n")
    return reduced.join(medians, list(keys), "left")


def price_by_country(
    transactions: DataFrame, arms: tuple[str, str] = ("control", "test"),
    country: str = "country", arm: str = "comparison", least_buyers: int = 2,
) -> DataFrame:
    """Median price of both arms per country and their ratio, where both arms have enough buyers."""
    control, test = arms
    wide = (
        price_by(transactions, [country, arm])
        .groupBy(country)
        .pivot(arm, [control, test])
        .agg(F.first("median_revenue").alias("median"), F.first("buyers").alias("buyers"))
    )
    buyers = [F.coalesce(F.col(f"{a}_buyers"), F.lit(0)) for a in arms]
    return (
        wide.where((buyers[0] >= least_buyers) & (buyers[1] >= least_buyers))
        .withColumn("price_ratio", ratio(F.col(f"{test}_median"), F.col(f"{control}_median")))
    )
