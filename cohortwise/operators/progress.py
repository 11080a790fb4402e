"""Progress that is lost and won back: retry chains and spending after a rollback.

The progress table has ``user_id, time, event_id`` and a level column, as in ``engagement``. A
rollback is a level below the one before; it is recovered at the first later event that
reaches the best level held before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwise.functions.columns import ratio
from cohortwise.operators.engagement import level_lists, rollback_events
from cohortwise.operators.timeline import CHUNK

#: Where a user stands: no chain, rolled back, tried again, won back but not at the goal.
CLEAR, OPENED, RETRIED, RECOVERED = range(4)
COUNTERS = ("episodes", "retried", "recovered", "completed")


def _entry(state: int) -> Column:
    """A slice that is entered in ``state``, before its first event."""
    zero = F.lit(0).cast("long")
    return F.struct(
        F.lit(state).alias("state"), F.lit(True).alias("own"), zero.alias("length"),
        *[zero.alias(c) for c in COUNTERS], zero.alias("won_tries"), zero.alias("longest"),
        F.lit(None).cast("long").alias("own_won"),
    )


def _step(m: Column, drop: Column, peak: Column, done: Column) -> Column:
    """The automaton's next state; ``own`` marks the chain that was open when the slice began."""
    open_ = m["state"].isin(OPENED, RETRIED)
    opens = ~open_ & drop
    wins = open_ & peak
    length = m["length"] + open_.cast("long")
    ends = (wins | (m["state"] == RECOVERED)) & done & ~opens
    state = (
        F.when(opens, OPENED).when(ends, CLEAR).when(wins, RECOVERED).when(open_, RETRIED).otherwise(m["state"])
    )
    own = m["own"] & ~opens
    one = lambda c: c.cast("long")
    return F.struct(
        state.alias("state"), own.alias("own"), F.when(opens, F.lit(0).cast("long")).otherwise(length).alias("length"),
        (m["episodes"] + one(opens)).alias("episodes"),
        (m["retried"] + one(m["state"] == OPENED)).alias("retried"),
        (m["recovered"] + one(wins)).alias("recovered"), (m["completed"] + one(ends)).alias("completed"),
        (m["won_tries"] + F.when(wins & ~m["own"], length).otherwise(F.lit(0).cast("long"))).alias("won_tries"),
        F.when(open_ & ~m["own"], F.greatest(m["longest"], length)).otherwise(m["longest"]).alias("longest"),
        F.when(wins & m["own"], length).otherwise(m["own_won"]).alias("own_won"),
    )


def chain_maps(events: DataFrame, level: str, goal: Column | float, slices: int | None = None) -> DataFrame:
    """Per user and slice: for every state it may begin in, the state after it and what it adds.

    Also the first and best level and the number of events, for the progress of a user.
    """
    lists = level_lists(events, level, slices).withColumn("goal", goal if isinstance(goal, Column) else F.lit(goal))
    kind = lists.schema["events"].dataType.elementType["level"].dataType
    entries = F.array(*[_entry(s) for s in (CLEAR, OPENED, RETRIED, RECOVERED)])
    start = F.struct(
        F.col("entry_last").cast(kind).alias("last"), F.col("entry_top").cast(kind).alias("top"), entries.alias("maps")
    )
    goal_ = F.col("goal")

    def read(done: Column, e: Column) -> Column:
        drop = F.coalesce(e["level"] < done["last"], F.lit(False))
        peak = F.coalesce(e["level"] >= done["top"], F.lit(True))
        reached = F.coalesce(e["level"] >= goal_, F.lit(False))
        return F.struct(
            e["level"].alias("last"), F.greatest(done["top"], e["level"]).alias("top"),
            F.transform(done["maps"], lambda m: _step(m, drop, peak, reached)).alias("maps"),
        )

    folded = F.aggregate("events", start, read)
    return lists.select(
        "user_id", CHUNK, folded.alias("f"), F.get("events", F.lit(0))["level"].alias("first"),
        F.size("events").cast("long").alias("n"),
    ).select("user_id", CHUNK, "first", "n", "f.top", "f.maps")


def user_chains(maps: DataFrame) -> DataFrame:
    """One row per user: the maps of the slices, applied in order from a clear state."""
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.lit(CLEAR).alias("state"), zero.alias("length"), *[zero.alias(c) for c in COUNTERS],
        zero.alias("won_tries"), zero.alias("longest"),
    )

    def apply(u: Column, part: Column) -> Column:
        m = F.element_at(part["maps"], u["state"] + 1)
        met = u["state"].isin(OPENED, RETRIED)
        # What the slice adds to the chain that was open before it.
        whole = u["length"] + F.coalesce(m["own_won"], F.when(m["own"], m["length"]), zero)
        whole = F.when(met, whole).otherwise(zero)
        won = F.when(met & m["own_won"].isNotNull(), u["length"] + m["own_won"]).otherwise(zero)
        return F.struct(
            m["state"].alias("state"),
            F.when(m["own"], F.when(met, u["length"] + m["length"]).otherwise(zero)).otherwise(m["length"]).alias("length"),
            *[(u[c] + m[c]).alias(c) for c in COUNTERS],
            (u["won_tries"] + m["won_tries"] + won).alias("won_tries"),
            F.greatest(u["longest"], m["longest"], whole).alias("longest"),
        )

    ordered = maps.groupBy("user_id").agg(
        F.array_sort(F.collect_list(F.struct(CHUNK, "maps"))).alias("parts"),
        F.sum("n").alias("n"), F.max("top").alias("top"), F.min_by("first", CHUNK).alias("first"),
    )
    return ordered.select(
        "user_id", "n", (F.col("top") - F.col("first")).cast("double").alias("gained"),
        F.aggregate("parts", start, apply).alias("u"),
    ).select("user_id", "n", "gained", "u.*")


def retry_chains(
    events: DataFrame, level: str, goal: float | None = None, slices: int | None = None,
) -> DataFrame:
    """From rollback to retry, recovery and completion, and attempts per clean level: one row.

    A chain begins with a rollback while none is open; further rollbacks belong to it. It is
    retried at the user's next event, recovered at the first event that reaches the best level
    so far, and completed if the goal is reached from there on before another rollback. The
    goal is the highest level of the table unless given. Attempts of a chain are the events
    after its first up to its recovery. Attempts per clean level are all events after a user's
    first, over the levels between a user's first and best. Events without level or time play
    no part. Results do not depend on the number of time slices.
    """
    top = events.agg(F.max(level)).scalar() if goal is None else F.lit(goal)
    users = user_chains(chain_maps(events, level, top, slices))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = users.agg(
        F.count("*").alias("users"), *[total(c).alias(c) for c in COUNTERS],
        F.count_if(F.col("state").isin(OPENED, RETRIED)).alias("stuck_users"),
        total("won_tries").alias("won_tries"), F.coalesce(F.max("longest"), F.lit(0)).alias("longest_chain"),
        total(F.col("n") - 1).alias("attempts"), F.sum("gained").alias("gained"),
    )
    return sums.select(
        "users", *COUNTERS, "stuck_users", "longest_chain", "attempts",
        ratio(F.col("retried"), F.col("episodes")).alias("retry_share"),
        ratio(F.col("recovered"), F.col("retried")).alias("recovery_share"),
        ratio(F.col("completed"), F.col("recovered")).alias("completion_share"),
        ratio(F.col("won_tries"), F.col("recovered")).alias("attempts_to_recover"),
        ratio(F.col("attempts"), F.col("gained")).alias("attempts_per_level"),
    )


def spend_within(
    marks: DataFrame, spend: DataFrame, hours: float, mark: str = "mark_id",
) -> DataFrame:
    """Per mark: purchases and money of the same user in the ``hours`` after it.

    ``marks`` has ``mark_id, user_id, time``, ``spend`` has ``user_id, time, value``. Time is cut
    into bins as wide as the horizon, so the horizon of a mark begins in its bin and ends in
    the next. Its two ends are put among the user's purchases of each bin, and running sums up
    to them give the difference: every mark makes two rows and no purchase is copied, however
    many marks and purchases one user has. Purchases at the time of the mark do not count,
    those at the end of the horizon do. Marks without user or time, and purchases without, have
    no part.
    """
    width = int(hours * 3_600_000_000)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    # Whole numbers: a quotient of doubles could put the end of a horizon into a wrong bin.
    whole = lambda t: F.expr(f"({t} - pmod({t}, {width}L)) div {width}L")
    paid = spend.where(F.col("user_id").isNotNull() & F.col("time").isNotNull()).select(
        "user_id", micros("time").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast(marks.schema[mark].dataType).alias(mark),
        F.col("value").cast("double").alias("value"), F.lit(1).cast("long").alias("n"),
    )
    known = marks.where(F.col("user_id").isNotNull() & F.col("time").isNotNull()).select(
        "user_id", mark, micros("time").alias("from")
    )
    ends = known.select("user_id", mark, F.explode(F.array(
        F.struct(F.col("from").alias("at"), F.lit(1).alias("kind")),
        F.struct((F.col("from") + width).alias("at"), F.lit(2).alias("kind")),
    )).alias("e")).select(
        "user_id", "e.at", "e.kind", mark, F.lit(None).cast("double").alias("value"), F.lit(0).cast("long").alias("n")
    )
    rows = paid.unionByName(ends).withColumn("bin", whole("at"))
    place = W.partitionBy("user_id", "bin")
    upto = place.orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = rows.select(
        mark, "kind", *[
            F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{name}_{c}")
            for c in ("value", "n") for name, w in (("upto", upto), ("all", place))
        ],
    ).where(F.col("kind") > 0)
    inside = lambda c: F.when(
        F.col("kind") == 1, F.col(f"all_{c}") - F.col(f"upto_{c}")
    ).otherwise(F.col(f"upto_{c}"))
    return sums.groupBy(mark).agg(F.sum(inside("value")).alias("spent"), F.sum(inside("n")).alias("purchases"))


def spend_after_rollback(
    events: DataFrame, level: str, spend: DataFrame, hours: float = 24.0, slices: int | None = None,
) -> DataFrame:
    """Purchases in the hours after a rollback, and how they go with recovery: one row.

    A purchase counts for every rollback whose horizon it lies in. A recovered share of paying
    rollbacks well above that of the others is a sign that progress is for sale.
    """
    rollbacks = rollback_events(events, level, slices).where("level < previous_level").select(
        F.col("event_id").alias("mark_id"), "user_id", "time", F.col("recovered_at").isNotNull().alias("recovered")
    )
    found = spend_within(rollbacks, spend, hours)
    per_mark = rollbacks.join(found, "mark_id")
    paying = F.col("purchases") > 0
    return per_mark.agg(
        F.count("*").alias("rollbacks"), F.count_if(paying).alias("paying_rollbacks"),
        ratio(F.count_if(paying), F.count("*")).alias("paying_share"),
        ratio(F.sum("purchases"), F.count("*")).alias("purchases_per_rollback"),
        ratio(F.sum("spent"), F.count("*")).alias("spent_per_rollback"),
        ratio(F.count_if(paying & F.col("recovered")), F.count_if(paying)).alias("recovered_share_paying"),
        ratio(F.count_if(~paying & F.col("recovered")), F.count_if(~paying)).alias("recovered_share_others"),
    )
