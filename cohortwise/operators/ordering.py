"""Exact order statistics without bringing a group into one task.

Ranks, cumulative distributions and quantiles all need "how many values are at most
this one". A window ordered over a whole group would sort that group in one task, and
the built-in exact percentile keeps all its distinct values in one buffer. Here the
values are first counted per distinct value (ties collapse on the map side), the value
range is cut at approximate quantiles, every slice is summed on its own, and the slice
totals - a few per group - supply the offset.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

SLICE = "_slice"


def cut_points(df: DataFrame, value: str, slices: int) -> list[float]:
    """Approximate quantiles of the column: at most ``slices - 1`` numbers.

    They decide only where the range is cut, never a result. As plain numbers they stay
    the same for every branch and every retry of the job that uses them.
    """
    if slices < 2:
        return []
    probabilities = [i / slices for i in range(1, slices)]
    found = df.approxQuantile(value, probabilities, 0.25 / slices)
    return sorted({point for point in found if math.isfinite(point)})


def sliced(df: DataFrame, value: str, points: Sequence[float]) -> DataFrame:
    """Add the slice number of each value; without cut points there is one slice."""
    if not points:
        return df.withColumn(SLICE, F.lit(0))
    splits = [float("-inf"), *points, float("inf")]
    placed = Bucketizer(splits=splits, inputCol=value, outputCol=SLICE).transform(df)
    return placed.withColumn(SLICE, F.col(SLICE).cast("int"))


def running_counts(
    df: DataFrame, keys: Sequence[str], value: str,
    extra: Mapping[str, Column] | None = None, slices: int | None = None, weight: str | None = None,
) -> DataFrame:
    """Per key and distinct value: ``n`` rows, ``running`` rows up to it, ``total`` rows.

    ``weight`` names a column of row counts where rows are counted already.
    ``extra`` adds aggregates per distinct value. Null keys and missing values are left out.
    One slice is for values known to have few distinct ones: it needs no cutting.
    """
    keys = list(keys)
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    for key in keys:
        known = known & F.col(key).isNotNull()
    present = df.where(known)
    names = [*keys, value, "n", "running", "total", *(extra or {})]
    counts = present.groupBy(*keys, value).agg(
        (F.sum(weight) if weight else F.count("*")).alias("n"), *[column.alias(name) for name, column in (extra or {}).items()]
    )
    if slices == 1:
        upto = W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
        return counts.select(
            "*",
            F.sum("n").over(upto).alias("running"),
            F.sum("n").over(W.partitionBy(*keys)).alias("total"),
        ).select(*names)
    counts = sliced(counts, value, cut_points(present, value, slices))
    place = [*keys, SLICE]
    # One row per key and slice from here on.
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.groupBy(*place).agg(F.sum("n").alias("_in_slice")).select(
        *place,
        F.coalesce(F.sum("_in_slice").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_in_slice").over(W.partitionBy(*keys)).alias("total"),
    )
    inside = W.partitionBy(*place).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        counts.withColumn("_inside", F.sum("n").over(inside))
        .join(offsets, place)
        .withColumn("running", F.col("_offset") + F.col("_inside"))
        .select(*names)
    )


def _first_beyond(value: str, index: Column) -> Column:
    """Value at a zero-based index of the sorted rows."""
    return F.min(F.when(F.col("running") > index, F.col(value)))


def interpolated(value: str, q: float) -> Column:
    """Aggregate over ``running_counts``: quantile with linear interpolation."""
    position = F.lit(q) * (F.col("total") - 1)
    low = _first_beyond(value, F.floor(position))
    high = _first_beyond(value, F.ceil(position))
    between = low + (high - low) * F.max(position - F.floor(position))
    return F.when(low == high, low).otherwise(between)


def at_index(value: str, q: float) -> Column:
    """Aggregate over ``running_counts``: the element at index floor(q * n)."""
    index = F.least(F.floor(F.lit(q) * F.col("total")), F.col("total") - 1)
    return _first_beyond(value, index)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float],
    by_index: bool = False, slices: int | None = None, weight: str | None = None,
) -> DataFrame:
    """Exact quantiles per key, one named column each.

    Linear interpolation by default; ``by_index`` takes the element at index floor(q * n).
    Without keys the result is one row.
    """
    rule = at_index if by_index else interpolated
    counted = running_counts(df, keys, value, slices=slices, weight=weight)
    columns = [rule(value, q).alias(name) for name, q in quantiles.items()]
    return counted.groupBy(*keys).agg(*columns)


def approximate_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float],
    accuracy: int = 10000,
) -> DataFrame:
    """One-shuffle alternative: error at most 1 / accuracy in rank."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        *[
            F.percentile_approx(value, q, accuracy).cast("double").alias(name)
            for name, q in quantiles.items()
        ]
    )
