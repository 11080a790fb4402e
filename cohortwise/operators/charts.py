"""Numbers behind the charts; drawing is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortwise.functions.columns import flag_sum, ratio
from cohortwise.operators.ordering import exact_quantiles, running_counts
from cohortwise.session import materialised


def histogram(df: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """Per group and bin of common width: count and density normalised per group.

    The top edge belongs to the last bin; empty bins are listed with zero.
    """
    number = F.col(value).cast("double")
    known = df.where(number.isNotNull() & ~F.isnan(number) & F.col(group).isNotNull())
    edges = known.agg(
        F.struct(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))
        .alias("edges")
    ).scalar()
    placed = known.select(group, F.col(value).cast("double").alias("_v"), edges.alias("_e"))
    width = (F.col("_e.high") - F.col("_e.low")) / bins
    index = F.least(F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_e.low"), width)), F.lit(0)), F.lit(bins - 1))
    counts = placed.groupBy(group, index.cast("int").alias("bin")).agg(F.count("*").alias("count"))
    totals = counts.groupBy(group).agg(F.sum("count").alias("_total"))
    grid = totals.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return (
        grid.join(counts, [group, "bin"], "left")
        .withColumn("_e", edges)
        .withColumn("count", F.coalesce("count", F.lit(0)))
        .select(
            group,
            "bin",
            (F.col("_e.low") + F.col("bin") * width).alias("left_edge"),
            "count",
            ratio(F.col("count"), F.col("_total") * width).alias("density"),
        )
    )


def ecdf(df: DataFrame, group: str, value: str, slices: int | None = None) -> DataFrame:
    """Per group and distinct value: share of rows at or below it."""
    counted = running_counts(df, [group], value, slices=slices)
    return counted.select(
        group, value, "n", ratio(F.col("running"), F.col("total")).alias("share")
    )


def box_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and outliers per group.

    The quartiles are one row per group; the second pass joins them to the values.
    """
    # Equal values are counted once; everything else reads these counts.
    counts = materialised(df.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n")))
    quartiles = exact_quantiles(counts, [group], value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, weight="n")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fenced = quartiles.select(
        group, "q1", "median", "q3", (F.col("q1") - reach).alias("_low"), (F.col("q3") + reach).alias("_high")
    )
    v = F.col(value)
    inside = (v >= F.col("_low")) & (v <= F.col("_high"))
    return counts.join(fenced, group).groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
    )
