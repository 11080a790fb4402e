"""Stratified assignment of users to experiment arms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window as W, functions as F


def stratified_assignment(
    users: DataFrame, strata: Sequence[str], arms: Mapping[str, int], user: str = "user_id", seed: str = "1",
) -> DataFrame:
    """Adds ``arm``: a keyed permutation inside each stratum, dealt out in exact proportions.

    ``arms`` maps arms to whole shares. A user's place is the rank of a hash of seed and user
    in the stratum, so it depends on nothing else and stays on retries and at any number of
    tasks; in a stratum arm sizes differ from their shares by less than one round. Ranks are
    counted in slices of the hash's first digits and set off by the sizes of earlier slices, so
    no stratum passes one task. A null is a stratum of its own. Several rows of a user get the
    same hash and follow each other; users should be unique.
    """
    if not arms or any(n < 1 for n in arms.values()):
        raise ValueError("every arm needs a share of at least 1")
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col(user).cast("string")))
    # A struct keeps nulls apart and equal to each other in joins.
    named = users.withColumn("_stratum", F.to_json(F.struct(*strata))).withColumn("_order", order).withColumn(
        "_slice", F.substring("_order", 1, 3)
    )
    place = ["_stratum", "_slice"]
    before = W.partitionBy("_stratum").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # At most 4096 rows a stratum.
    sizes = named.groupBy(*place).agg(F.count("*").alias("_n")).select(
        *place, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(W.partitionBy(*place).orderBy("_order", user))
    ranked = named.withColumn("_inside", inside).join(sizes, place)
    seats = [arm for arm, n in arms.items() for _ in range(n)]
    seat = F.pmod(F.col("_before") + F.col("_inside") - 1, F.lit(len(seats))).cast("int")
    return ranked.select(*users.columns, F.get(F.array(*[F.lit(a) for a in seats]), seat).alias("arm"))
