"""Connected components of a large graph by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.llm.common import kept


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``id`` and ``label``, the smallest id reachable, for every end of an edge.

    Ends are longs. A round maps every vertex to the first of its neighbours and itself, in the
    order of a hash, and puts the images in place of the ends; loops and repeats fall away, so a
    dense group of copies is small after one round, and the hash keeps chains from taking one
    round a step. The maps of all rounds, one after the other, give the labels. Minima
    are combined before each shuffle, and joins are left to adaptive skew splitting, so a
    vertex with very many neighbours is no single task. The driver only learns whether edges
    are left. No edges, no rows.
    """
    def ordered(rows: DataFrame) -> DataFrame:
        ends = rows.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        return kept(ends.where("x <> y").distinct())

    def rank(column: str) -> Column:
        return F.struct(F.xxhash64(column).alias("h"), F.col(column).alias("v"))

    rest = ordered(edges.select(F.col(left).alias("x"), F.col(right).alias("y")))
    labels: DataFrame | None = None
    while labels is None or not rest.isEmpty():
        both = rest.union(rest.select("y", "x"))
        nearest = both.groupBy("x").agg(F.min(rank("y")).alias("y"))
        image = kept(nearest.select(
            F.col("x").alias("id"), F.least(rank("x"), F.col("y"))["v"].alias("label")
        ))
        if labels is None:
            labels = image
        else:
            later = image.select(F.col("id").alias("label"), F.col("label").alias("next"))
            labels = kept(labels.join(later, "label", "left").select(
                "id", F.coalesce("next", "label").alias("label")
            ))
        first = image.select(F.col("id").alias("x"), F.col("label").alias("p"))
        second = image.select(F.col("id").alias("y"), F.col("label").alias("q"))
        rest = ordered(
            rest.join(first, "x").join(second, "y").select(F.col("p").alias("x"), F.col("q").alias("y"))
        )
    smallest = labels.groupBy("label").agg(F.min("id").alias("low"))
    return labels.join(smallest, "label").select("id", F.col("low").alias("label"))
