"""Event engagement: reach, funnels, sessions, churn, stickiness, rollbacks.

The event table has ``user_id, time, event_id`` and a step or level column; ``event_id``
breaks ties of equal times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwise.functions.columns import flag_sum, ratio
from cohortwise.operators.ordering import exact_quantiles
from cohortwise.operators.timeline import (
    CHUNK, carried, highest_before, lowest_after, next_time, previous, with_slice,
)
from cohortwise.session import materialised


def event_reach(events: DataFrame, seen: str, started: str, month: int = 30) -> DataFrame:
    """Per day: users who saw and who started the event, as shares of DAU and of MAU."""
    flags = events.groupBy(F.to_date("time").alias("date"), "user_id").agg(
        F.max((F.col("event_type") == seen).cast("int")).alias("saw"),
        F.max((F.col("event_type") == started).cast("int")).alias("began"),
    )
    daily = flags.groupBy("date").agg(
        F.sum("saw").alias("seen_users"),
        F.sum("began").alias("started_users"),
        F.sum(F.col("saw") * F.col("began")).alias("_both"),
    )
    # Both sides have one row per day.
    return daily.join(stickiness(events, month), "date").select(
        "date",
        "dau",
        "mau",
        "seen_users",
        "started_users",
        ratio(F.col("seen_users"), F.col("dau")).alias("reach"),
        ratio(F.col("started_users"), F.col("dau")).alias("participation"),
        ratio(F.col("started_users"), F.col("mau")).alias("participation_of_mau"),
        ratio(F.col("_both"), F.col("seen_users")).alias("seen_to_started"),
    )


def first_participation(events: DataFrame, kind: str) -> DataFrame:
    """First event of a kind per user, in the form of a registration table."""
    first = events.where(F.col("event_type") == kind).groupBy("user_id").agg(F.min("time").alias("t"))
    return first.select(
        F.unix_seconds(F.col("t").cast("timestamp")).alias("reg_ts"), F.col("user_id").alias("uid")
    )


def _ordered(events: DataFrame, steps: Sequence[str], slices: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Per user and time slice the events of the steps as sorted (time, step number).

    A list is no longer than a slice, whatever a user does. Of equal times the earlier step
    comes first, so a step may follow at the very time of the one before it.
    """
    number = F.coalesce(*[F.when(F.col("event_type") == s, F.lit(i)) for i, s in enumerate(steps)])
    known = events.where(F.col("event_type").isin(list(steps)) & F.col("time").isNotNull())
    cut = with_slice(known.select("user_id", *by, "time", number.alias("step")), "time", slices)
    return cut.groupBy("user_id", *by, CHUNK).agg(
        F.array_sort(F.collect_list(F.struct("time", "step"))).alias("events")
    )


def funnel(
    events: DataFrame, steps: Sequence[str], slices: int | None = None, by: Sequence[str] = (),
    reward: str | None = None,
) -> DataFrame:
    """Users per step, conversion from the step before and from the start, and drop-off.

    ``by`` names columns that do not change within a user, such as a channel; there is a funnel
    for each of their values. ``reward`` adds the share of the users of the first step who
    finish and have an event of that type at or after the last step. A step is reached at its first event at or after the time the step before it was reached.
    Every slice of a user's time maps the steps done before it to the steps done after it;
    the maps of a user, one per slice, are then applied in order.
    """
    count, by = len(steps), list(by)
    if len({*steps, *([reward] if reward else [])}) < count + bool(reward):
        raise ValueError("steps of a funnel are distinct")
    if reward:
        return _rewarded(events, steps, reward, slices, by)
    entered = F.sequence(F.lit(0), F.lit(count))
    done = F.aggregate(
        "events", entered,
        lambda state, e: F.transform(state, lambda s: s + (s == e["step"]).cast("int")),
    )
    maps = _ordered(events, steps, slices, by).select("user_id", *by, CHUNK, done.alias("map"))
    ordered = maps.groupBy("user_id", *by).agg(F.array_sort(F.collect_list(F.struct(CHUNK, "map"))).alias("maps"))
    reached = ordered.select(
        *by, F.aggregate("maps", F.lit(0), lambda s, m: F.element_at(m["map"], s + 1)).alias("reached")
    )
    counts = reached.groupBy(*by).agg(*[F.count_if(F.col("reached") > i).alias(f"c{i}") for i in range(count)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("long").alias("step"),
                F.lit(name).alias("name"),
                F.col(f"c{i}").alias("users"),
                ratio(F.col(f"c{i}"), F.col(f"c{max(i - 1, 0)}")).alias("from_previous"),
                ratio(F.col(f"c{i}"), F.col("c0")).alias("from_start"),
                (F.col(f"c{max(i - 1, 0)}") - F.col(f"c{i}")).alias("dropped"),
            )
            for i, name in enumerate(steps)
        ]
    )
    return counts.select(*by, F.inline(rows))


def _rewarded(
    events: DataFrame, steps: Sequence[str], reward: str, slices: int | None, by: list[str],
) -> DataFrame:
    """The funnel with the reward as a step of its own, told as a share beside every step."""
    whole = funnel(events, [*steps, reward], slices, by)
    last = whole.where(F.col("step") == len(steps) + 1).select(*by, F.col("from_start").alias("reward_share"))
    steps_ = whole.where(F.col("step") <= len(steps))
    # One row per segment.
    joined = steps_.join(last, by) if by else steps_.withColumn("reward_share", last.select("reward_share").scalar())
    return joined.select(*by, "step", "name", "users", "from_previous", "from_start", "dropped", "reward_share")


def time_to_step(
    events: DataFrame, start: str, attempt: str, goal: str, slices: int | None = None,
) -> DataFrame:
    """Users who reach the goal: median and mean seconds from start, median and mean attempts.

    The goal is the first one at or after the first start. Attempts are those up to the goal.
    A slice of a user's time says when it starts, where its first goal lies - anywhere, and
    after its first start - and how many attempts come before; the slices are then read in
    order. Raw events meet no join.
    """
    ordered = _ordered(events, [start, attempt, goal], slices)

    def first(step: int, since: Column | None = None) -> Column:
        later = lambda e: (e["step"] == step) & (F.lit(True) if since is None else e["time"] >= since)
        return F.get(F.filter("events", later), F.lit(0))["time"]

    def tries(until: Column) -> Column:
        return F.size(F.filter("events", lambda e: (e["step"] == 1) & (e["time"] <= until))).cast("long")

    parts = ordered.select("user_id", CHUNK, "events", first(0).alias("t0"), first(2).alias("any_goal"))
    parts = parts.select("*", first(2, F.col("t0")).alias("own_goal")).select(
        "user_id",
        F.struct(
            CHUNK, "t0", "any_goal", tries(F.col("any_goal")).alias("any_tries"), "own_goal",
            tries(F.col("own_goal")).alias("own_tries"),
            F.size(F.filter("events", lambda e: e["step"] == 1)).cast("long").alias("tries"),
        ).alias("part"),
    )
    kind = parts.schema["part"].dataType["t0"].dataType
    nothing = F.struct(
        F.lit(None).cast(kind).alias("t0"), F.lit(None).cast(kind).alias("goal"),
        F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("attempts"),
    )

    def read(state: Column, p: Column) -> Column:
        began = state["t0"].isNotNull()
        goal = F.when(began, p["any_goal"]).otherwise(p["own_goal"])
        here = F.when(began, p["any_tries"]).otherwise(p["own_tries"])
        fresh = state["goal"].isNull() & goal.isNotNull()
        return F.struct(
            F.coalesce(state["t0"], p["t0"]).alias("t0"), F.coalesce(state["goal"], goal).alias("goal"),
            (state["seen"] + p["tries"]).alias("seen"),
            F.when(fresh, state["seen"] + here).otherwise(state["attempts"]).alias("attempts"),
        )

    users = parts.groupBy("user_id").agg(F.array_sort(F.collect_list("part")).alias("parts")).select(
        F.aggregate("parts", nothing, read).alias("u")
    ).where(F.col("u.goal").isNotNull())
    # Read for the means, the cut points and both medians.
    per_user = materialised(users.select(
        (F.timestamp_diff("MICROSECOND", F.col("u.t0"), F.col("u.goal")) / F.lit(1e6)).alias("seconds"),
        F.col("u.attempts").alias("attempts"),
    ))
    # Nearly every user has a time of their own, so times are ranked in slices.
    medians = [
        exact_quantiles(per_user, [], c, {"median": 0.5}, slices=slices).scalar().alias(f"median_{c}")
        for c in ("seconds", "attempts")
    ]
    return per_user.agg(
        F.count("*").alias("users"),
        F.avg("seconds").alias("mean_seconds"),
        F.avg("attempts").alias("mean_attempts"),
    ).select("*", *medians)


def user_sessions(
    events: DataFrame, gap_minutes: int = 30, slices: int | None = None,
) -> DataFrame:
    """Per user and day: sessions started (a pause longer than the gap starts one) and events."""
    timed = with_slice(events.select("user_id", "time", "event_id"), "time", slices)
    known = carried(
        timed, "user_id", ["time", "event_id"], [highest_before("previous", F.col("time"))]
    )
    pause = F.timestamp_diff("MICROSECOND", F.col("previous"), F.col("time"))
    starts = F.col("previous").isNull() | (pause > gap_minutes * 60 * 1_000_000)
    return known.groupBy("user_id", F.to_date("time").alias("date")).agg(
        flag_sum(starts).alias("sessions"), F.count("*").alias("events")
    )


def session_summary(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Users, sessions, active days, sessions per user, events per session, active days per user."""
    per_user = user_sessions(events, gap_minutes).groupBy("user_id").agg(
        F.sum("sessions").alias("sessions"), F.sum("events").alias("events"), F.count("*").alias("days")
    )
    return per_user.agg(
        F.count("*").alias("users"),
        F.sum("sessions").alias("sessions"),
        F.sum("days").alias("active_days"),
        ratio(F.sum("sessions"), F.count("*")).alias("sessions_per_user"),
        ratio(F.sum("events"), F.sum("sessions")).alias("events_per_session"),
        ratio(F.sum("days"), F.count("*")).alias("days_per_user"),
    )


def session_spans(events: DataFrame, gap_minutes: int = 30, slices: int | None = None) -> DataFrame:
    """One row per session: user, start, end and length in seconds.

    A session starts after a pause longer than the gap and ends before the next one; its end
    is the first closing event at or after its start.
    """
    order = ["time", "event_id"]
    pause = lambda a, b: F.timestamp_diff("MICROSECOND", a, b) > gap_minutes * 60 * 1_000_000
    timed = with_slice(events.select("user_id", *order), "time", slices)
    timed = carried(
        timed, "user_id", order,
        [highest_before("previous", F.col("time")), next_time("following", "time")],
    )
    opens = F.col("previous").isNull() | pause(F.col("previous"), F.col("time"))
    closes = F.col("following").isNull() | pause(F.col("time"), F.col("following"))
    marked = timed.select("user_id", *order, CHUNK, opens.alias("opens"), closes.alias("closes"))
    closing = F.when(F.col("closes"), F.col("time"))
    ended = carried(marked, "user_id", order, [lowest_after("later", closing)])
    return ended.where("opens").select(
        "user_id",
        F.col("time").alias("start"),
        F.coalesce(closing, F.col("later")).alias("end"),
    ).withColumn("seconds", F.timestamp_diff("MICROSECOND", F.col("start"), F.col("end")) / F.lit(1e6))


def session_lengths(events: DataFrame, gap_minutes: int = 30, slices: int | None = None) -> DataFrame:
    """Per day of the start: sessions, mean and longest length in seconds, sessions of one event."""
    return session_spans(events, gap_minutes, slices).groupBy(F.to_date("start").alias("date")).agg(
        F.count("*").alias("sessions"),
        F.avg("seconds").alias("mean_seconds"),
        F.max("seconds").alias("longest_seconds"),
        F.count_if(F.col("seconds") == 0).alias("instant_sessions"),
    )


def participants_by_age(events: DataFrame, started: str) -> DataFrame:
    """Per day: users who started the event, split into those new that day and returned ones.

    A user is new on the day of their first event of any kind.
    """
    daily = events.groupBy("user_id", F.to_date("time").alias("date")).agg(
        F.max((F.col("event_type") == started).cast("int")).alias("began")
    )
    first = events.groupBy("user_id").agg(F.min(F.to_date("time")).alias("first_date"))
    joined = daily.where("began = 1").join(first, "user_id")
    new = F.col("date") == F.col("first_date")
    return joined.groupBy("date").agg(
        F.count("*").alias("participants"),
        F.count_if(new).alias("new_participants"),
        F.count_if(~new).alias("returned_participants"),
        ratio(F.count_if(new), F.count("*")).alias("new_share"),
    )


def churn_after(
    events: DataFrame, participation: str, start: str, end: str, horizons: Sequence[int] = (1, 3, 7)
) -> DataFrame:
    """Participants of the period and those with no event in the N days after it."""
    day = F.to_date("time")
    last = F.lit(end).cast("date")
    took_part = (F.col("event_type") == participation) & day.between(F.lit(start).cast("date"), last)
    seen = events.where(day.between(F.lit(start).cast("date"), F.date_add(last, max(horizons))))
    per_user = seen.groupBy("user_id").agg(
        F.max(took_part.cast("int")).alias("took_part"),
        F.min(F.when(day > last, day)).alias("returned"),
    ).where(F.col("took_part") == 1)
    stayed = [
        F.count_if(F.coalesce(F.col("returned") <= F.date_add(last, n), F.lit(False))).alias(f"s{n}")
        for n in horizons
    ]
    counts = per_user.agg(F.count("*").alias("participants"), *stayed)
    rows = F.array(
        *[
            F.struct(
                F.lit(n).cast("long").alias("days"),
                F.col("participants"),
                (F.col("participants") - F.col(f"s{n}")).alias("churned"),
                ratio(F.col("participants") - F.col(f"s{n}"), F.col("participants")).alias("churn"),
            )
            for n in horizons
        ]
    )
    return counts.select(F.inline(rows))


def stickiness(events: DataFrame, days: int = 30) -> DataFrame:
    """Per day: DAU, distinct users of the trailing ``days`` days, and DAU / MAU.

    An active day keeps a user in the trailing count until the user's next active day or
    until it leaves the window, whichever comes first. Those spans never overlap for one
    user, so a running sum of entries and exits counts each user once, without copying a
    row for every day of the window.
    """
    active = events.select("user_id", F.to_date("time").alias("date")).distinct()
    following = F.lead("date").over(W.partitionBy("user_id").orderBy("date"))
    leaves = F.date_add("date", days)
    spans = active.select(
        "date", F.least(leaves, F.coalesce(following, leaves)).alias("until")
    )
    changes = spans.groupBy("date").agg(F.count("*").alias("change"), F.count("*").alias("dau")).unionByName(
        spans.groupBy(F.col("until").alias("date")).agg(
            (-F.count("*")).alias("change"), F.lit(0).cast("long").alias("dau")
        )
    )
    # One row per calendar day from here on.
    daily = changes.groupBy("date").agg(F.sum("change").alias("change"), F.sum("dau").alias("dau"))
    calendar = W.orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = daily.withColumn("mau", F.sum("change").over(calendar))
    return counted.where(F.col("dau") > 0).select(
        "date", "dau", "mau", ratio(F.col("dau"), F.col("mau")).alias("stickiness")
    )


def rollback_events(events: DataFrame, level: str, slices: int | None = None) -> DataFrame:
    """Progress events with the level before, the best level before and the next events.

    A rollback is a level below the previous one. It is recovered at the first later event
    that reaches the best level held before it. ``peak`` marks the events that reach the
    best level so far; until recovery no event does, so the next peak is the recovery.
    """
    order = ["time", "event_id"]
    steps = with_slice(
        events.where(F.col(level).isNotNull()).select("user_id", *order, F.col(level).alias("level")),
        "time", slices,
    )
    steps = carried(
        steps, "user_id", order,
        [
            previous("previous_level", "level", order),
            highest_before("previous_time", F.col("time")),
            highest_before("best", F.col("level")),
            next_time("next_time", "time"),
        ],
    )
    peak = F.coalesce(F.col("level") >= F.col("best"), F.lit(True))
    peak_time = F.when(peak, F.col("time"))
    steps = carried(steps, "user_id", order, [lowest_after("recovered_at", peak_time)])
    return steps.select(
        "user_id", *order, "level", "previous_time", "previous_level", "recovered_at", "next_time",
    )


def level_lists(events: DataFrame, level: str, slices: int | None = None) -> DataFrame:
    """Per user and time slice: its progress events in order, and what lies around them.

    ``entry_last``, ``entry_time`` and ``entry_top`` are the last level, its time and the best
    level before the slice, ``next_time`` the time of the first event after it. A list is no
    longer than a slice, whatever a user does.
    """
    known = events.where(F.col(level).isNotNull() & F.col("time").isNotNull()).select(
        "user_id", "time", "event_id", F.col(level).alias("level")
    )
    lists = with_slice(known, "time", slices).groupBy("user_id", CHUNK).agg(
        F.array_sort(F.collect_list(F.struct("time", "event_id", "level"))).alias("events")
    )
    last, first = F.element_at("events", -1), F.get("events", F.lit(0))
    summary = lists.select(
        "user_id", CHUNK, last["level"].alias("last"), last["time"].alias("last_time"),
        first["time"].alias("first_time"), F.array_max(F.transform("events", lambda e: e["level"])).alias("top"),
    )
    # One row per user and slice.
    earlier = W.partitionBy("user_id").orderBy(CHUNK)
    around = summary.select(
        "user_id", CHUNK, F.lag("last").over(earlier).alias("entry_last"),
        F.lag("last_time").over(earlier).alias("entry_time"), F.lead("first_time").over(earlier).alias("next_time"),
        F.max("top").over(earlier.rowsBetween(W.unboundedPreceding, -1)).alias("entry_top"),
    )
    return lists.join(around, ["user_id", CHUNK])


def _rollback_sums(lists: DataFrame, end: Column, horizons: Sequence[int]) -> DataFrame:
    """Per user and slice: counts and sums of its rollbacks, those left open, and their depths.

    Times are microseconds before ``end``. Of open rollbacks only their number and the sum of
    their times are kept: the first event at the best level recovers all of them.
    """
    zero, nought = F.lit(0).cast("long"), F.lit(0.0)
    rows = lists.withColumn("_end", end)
    since = lambda t: F.timestamp_diff("MICROSECOND", F.col("_end"), t).cast("double")
    later = F.concat(F.slice(F.transform("events", lambda e: e["time"]), 2, F.size("events")), F.array("next_time"))
    pairs = F.zip_with("events", later, lambda e, n: F.struct(
        e["time"].alias("time"), e["level"].alias("level"), n.alias("next"), since(e["time"]).alias("at")
    ))
    kind = lists.schema["events"].dataType.elementType
    churn = [f"{c}{n}" for n in horizons for c in ("due", "silent")]
    start = F.struct(
        F.col("entry_last").cast(kind["level"].dataType).alias("last"), F.col("entry_time").alias("last_time"),
        F.col("entry_top").cast(kind["level"].dataType).alias("top"), F.lit(None).cast("double").alias("peak"),
        *[zero.alias(c) for c in ("lost", "open", "won", "changes", "days", *churn)],
        *[nought.alias(c) for c in ("open_at", "wait", "change")],
    )

    def read(s: Column, e: Column) -> Column:
        drop = F.coalesce(e["level"] < s["last"], F.lit(False))
        peak = F.coalesce(e["level"] >= s["top"], F.lit(True))
        one = lambda c: c.cast("long")
        opens_day = s["last_time"].isNull() | (F.to_date(s["last_time"]) < F.to_date(e["time"]))
        out = {
            "last": e["level"], "last_time": e["time"], "top": F.greatest(s["top"], e["level"]),
            "peak": F.coalesce(s["peak"], F.when(peak, e["at"])),
            "lost": s["lost"] + one(drop),
            "open": F.when(peak, zero).otherwise(s["open"] + one(drop)),
            "won": s["won"] + F.when(peak, s["open"]).otherwise(zero),
            "changes": s["changes"] + one(s["last"].isNotNull()),
            "days": s["days"] + one(opens_day),
        }
        for n in horizons:
            due = e["time"] + F.expr(f"interval {n} day")
            seen = drop & (due <= F.col("_end"))
            out[f"due{n}"] = s[f"due{n}"] + one(seen)
            out[f"silent{n}"] = s[f"silent{n}"] + one(seen & (e["next"].isNull() | (e["next"] > due)))
        out["open_at"] = F.when(peak, nought).otherwise(s["open_at"] + F.when(drop, e["at"]).otherwise(nought))
        out["wait"] = s["wait"] + F.when(peak, s["open"] * e["at"] - s["open_at"]).otherwise(nought)
        out["change"] = s["change"] + F.coalesce((e["level"] - s["last"]).cast("double"), nought)
        return F.struct(*[c.alias(name) for name, c in out.items()])

    levels = F.transform("events", lambda e: e["level"])
    before = F.concat(F.array(F.col("entry_last").cast(kind["level"].dataType)), F.slice(levels, F.lit(1), F.size(levels) - 1))
    depths = F.filter(F.zip_with(before, levels, lambda a, b: a - b), lambda d: d > 0)
    return rows.select(
        "user_id", CHUNK, F.aggregate(pairs, start, read).alias("f"), depths.alias("depths")
    ).select("user_id", CHUNK, "f.*", "depths").drop("last", "last_time", "top")


def rollback_metrics(
    events: DataFrame, level: str, horizons: Sequence[int] = (1, 3, 7), slices: int | None = None,
) -> DataFrame:
    """Frequency, mean and p95 depth, recovered share, time to recover, net progress, churn.

    Churn after N days counts rollbacks that can be observed for N days before the last
    event of the table and are followed by no event within them. Events are read in order once
    per user and slice; a user's slices are then put together in order.
    """
    end = events.agg(F.max("time")).scalar()
    sums = materialised(_rollback_sums(level_lists(events, level, slices), end, horizons))
    churn = [f"{c}{n}" for n in horizons for c in ("due", "silent")]
    parts = F.array_sort(F.collect_list(F.struct(CHUNK, "peak", "open", "open_at")))
    added = ("lost", "won", "changes", "days", "wait", "change", *churn)
    users = sums.groupBy("user_id").agg(parts.alias("parts"), *[F.sum(c).alias(c) for c in added])
    start = F.struct(*[F.lit(0.0).alias(c) for c in ("open", "open_at", "won", "wait")])

    def put(s: Column, p: Column) -> Column:
        met = p["peak"].isNotNull()
        keep = lambda c: F.when(met, 0.0).otherwise(s[c])
        return F.struct(
            (keep("open") + p["open"]).alias("open"), (keep("open_at") + p["open_at"]).alias("open_at"),
            (s["won"] + F.when(met, s["open"]).otherwise(0.0)).alias("won"),
            (s["wait"] + F.when(met, s["open"] * p["peak"] - s["open_at"]).otherwise(0.0)).alias("wait"),
        )

    totals = users.withColumn("u", F.aggregate("parts", start, put)).agg(
        *[F.sum(c).alias(c) for c in added if c not in ("won", "wait")],
        F.sum(F.col("won") + F.col("u.won")).alias("won"), F.sum(F.col("wait") + F.col("u.wait")).alias("wait"),
    )
    depth = sums.select(F.explode("depths").alias("depth"))
    few = depth.groupBy("depth").agg(F.count("*").alias("n"))
    # Depths are counted first, so no buffer holds all of them.
    p95 = exact_quantiles(few, [], "depth", {"p95": 0.95}, slices=1, weight="n").scalar()
    mean = depth.agg(F.avg("depth")).scalar()
    return totals.select(
        F.coalesce("lost", F.lit(0)).alias("rollbacks"), mean.alias("mean_depth"),
        ratio(F.col("won"), F.col("lost")).alias("recovered_share"),
        ratio(F.col("wait") / 1e6, F.col("won")).alias("mean_seconds_to_recover"),
        *[ratio(F.col(f"silent{n}"), F.col(f"due{n}")).alias(f"churn_{n}d") for n in horizons],
        ratio(F.col("lost"), F.col("changes")).alias("frequency"),
        ratio(F.col("change"), F.col("days")).alias("net_progress_per_day"),
        p95.cast("double").alias("p95_depth"),
    )
