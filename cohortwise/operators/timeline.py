"""Values carried along a user's ordered events, cut into time chunks.

A window over all events of a user would put a hot user into one task. The time axis is
therefore cut into slices of about equal row counts, events are ordered inside (user, slice)
and one summary row per user and slice carries the values across slices.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwise.operators.ordering import SLICE, cut_points, sliced

CHUNK = "_chunk"


class Carry(NamedTuple):
    """What a row takes from the user's other events.

    ``inside`` is the window function among the rows of the same chunk, ``summary`` the
    aggregate of a chunk and ``outside`` the window function over the summaries.
    """

    name: str
    inside: Column
    summary: Column
    outside: Callable[[Column], Column]
    combine: Callable[[Column, Column], Column]
    backwards: bool = False
    frame: bool = False

    def over(self, column: Column, keys: Sequence[str], order: Sequence[str]) -> Column:
        columns = [F.col(c).desc() if self.backwards else F.col(c).asc() for c in order]
        window = W.partitionBy(*keys).orderBy(*columns)
        return column.over(window.rowsBetween(W.unboundedPreceding, -1) if self.frame else window)


def previous(name: str, value: str, order: Sequence[str]) -> Carry:
    """Value at the event before."""
    return Carry(name, F.lag(value), F.max_by(value, F.struct(*order)), F.lag, F.coalesce)


def next_time(name: str, time: str) -> Carry:
    """Time of the event after; ``time`` is the first ordering column."""
    return Carry(name, F.lead(time), F.min(time), F.lead, F.coalesce)


def highest_before(name: str, value: Column) -> Carry:
    return Carry(name, F.max(value), F.max(value), F.max, F.greatest, frame=True)


def lowest_after(name: str, value: Column) -> Carry:
    """Computed as "before" on the reversed order, so the frame starts at the partition edge."""
    return Carry(name, F.min(value), F.min(value), F.min, F.least, backwards=True, frame=True)


def with_slice(df: DataFrame, ts: str, slices: int | None = None) -> DataFrame:
    """Cut the time axis into slices of about equal row counts.

    A user's part of a slice is bounded whatever the user does, at any size of the table. The
    cut points come from approximate quantiles and decide only where the axis is cut.
    """
    slices = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast("double")
    timed = df.withColumn("_micros", micros)
    points = cut_points(timed, "_micros", slices)
    return sliced(timed, "_micros", points).withColumnRenamed(SLICE, CHUNK).drop("_micros")


def carried(df: DataFrame, user: str, order: Sequence[str], carries: Sequence[Carry]) -> DataFrame:
    """Add one column per carry. Needs the column of ``with_slice``.

    All carries of one call share the window partitioning, one summary and one join; the
    summary and the windows read the same exchange.
    """
    place = [user, CHUNK]
    df = df.repartition(*place)
    summary = df.groupBy(*place).agg(*[c.summary.alias(f"_s_{c.name}") for c in carries])
    outside = summary.select(
        *place,
        *[
            c.over(c.outside(F.col(f"_s_{c.name}")), [user], [CHUNK]).alias(f"_o_{c.name}")
            for c in carries
        ],
    )
    inside = df.select(
        "*", *[c.over(c.inside, place, order).alias(f"_i_{c.name}") for c in carries]
    )
    return inside.join(outside, place).select(
        *df.columns,
        *[c.combine(F.col(f"_i_{c.name}"), F.col(f"_o_{c.name}")).alias(c.name) for c in carries],
    )
