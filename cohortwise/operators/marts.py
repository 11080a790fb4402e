"""Daily marts and dashboard metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from cohortwise.functions.columns import (
    AGE_BANDS, OLDEST_BAND, age_band, fixed_order, flag_sum, in_period, ratio,
)


def period(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows of the days ``start`` to ``end``; the one filter every chart shares."""
    return df.where(in_period(F.col(ts), start, end))


def new_entities(events: DataFrame, entity: str, ts: str, name: str = "new_posts") -> DataFrame:
    """Entities per day of their first appearance."""
    first = events.where(F.col(entity).isNotNull()).groupBy(entity).agg(F.min(ts).alias("_first"))
    return first.groupBy(F.to_date("_first").alias("date")).agg(F.count("*").alias(name))


def daily_users(actions: DataFrame, like: str = "like", view: str = "view") -> DataFrame:
    """Per day: dau, likes and views, counted per user first."""
    users = actions.groupBy(F.to_date("time").alias("date"), "user_id").agg(
        flag_sum(F.col("action") == like).alias("likes"),
        flag_sum(F.col("action") == view).alias("views"),
    )
    return users.groupBy("date").agg(
        F.count("user_id").alias("dau"),
        F.sum("likes").alias("likes"),
        F.sum("views").alias("views"),
    )


def posts_by_day(actions: DataFrame, view: str = "view") -> DataFrame:
    """One row per day and post: whether it was viewed."""
    return actions.where(F.col("post_id").isNotNull()).groupBy(F.to_date("time").alias("date"), "post_id").agg(
        F.max((F.col("action") == view).cast("int")).alias("viewed")
    )


def daily_mart(
    actions: DataFrame, before: str | None = None, like: str = "like", view: str = "view"
) -> DataFrame:
    """Per day: dau, likes, views, ctr, distinct viewed posts and posts seen for the first time.

    Distinct users and distinct posts are counted in separate two-step aggregates: rows
    shrink on the map side to (day, user) and (day, post), and no row is copied once per
    distinct count. ``before`` drops an incomplete last day.
    """
    kept = actions if before is None else actions.where(F.col("time") < F.lit(before).cast("timestamp_ntz"))
    daily = daily_users(kept, like, view)
    # The post pass answers both post questions: viewed on the day, and first day ever.
    # A post has at most one row per day here, so its window is as long as the calendar.
    posts = posts_by_day(kept, view)
    first_day = F.min("date").over(W.partitionBy("post_id"))
    by_day = posts.withColumn("is_new", F.col("date") == first_day).groupBy("date").agg(
        F.coalesce(F.sum("viewed"), F.lit(0)).alias("unique_viewed_posts"),
        flag_sum(F.col("is_new")).alias("new_posts"),
    )
    return (
        daily.join(by_day, "date", "left")
        .select(
            "date",
            "dau",
            "likes",
            "views",
            ratio(F.col("likes"), F.col("views")).alias("ctr"),
            F.coalesce("unique_viewed_posts", F.lit(0)).alias("unique_viewed_posts"),
            F.coalesce("new_posts", F.lit(0)).alias("new_posts"),
        )
    )


def dau_by_service(events: DataFrame) -> DataFrame:
    """Distinct users with an action per day and service."""
    seen = events.where(F.col("service").isNotNull() & F.col("user_id").isNotNull())
    once = seen.select(F.to_date("time").alias("date"), "service", "user_id").distinct()
    return once.groupBy("date", "service").agg(F.count("*").alias("dau"))


def service_overlap(events: DataFrame, base: str = "feed", other: str = "messenger") -> DataFrame:
    """Users of the base service and the share of them who also used the other one."""
    def used(service: str):
        return F.max((F.col("service") == service).cast("int"))

    flags = events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        used(base).alias("base"), used(other).alias("other")
    )
    both = flag_sum((F.col("base") == 1) & (F.col("other") == 1))
    total = flag_sum(F.col("base") == 1)
    return flags.agg(
        total.alias("base_users"), both.alias("both_users"), ratio(both, total).alias("overlap")
    )


def messages_by_gender(messages: DataFrame, people: DataFrame | None = None) -> DataFrame:
    """Messages sent (events, not users) per gender.

    With ``people`` (user_id, gender) the gender comes from there; messages are counted per
    user before they meet it.
    """
    if people is not None:
        per_user = messages.groupBy("user_id").agg(F.count("*").alias("n"))
        return per_user.join(people.where(F.col("gender").isNotNull()), "user_id").groupBy("gender").agg(
            F.sum("n").alias("messages")
        )
    return messages.where(F.col("gender").isNotNull()).groupBy("gender").agg(
        F.count("*").alias("messages")
    )


def messages_by_age(messages: DataFrame) -> DataFrame:
    """Messages sent per age band, with the position of the band."""
    banded = messages.select(age_band(F.col("age")).alias("age_band"))
    labels = [label for _, label in AGE_BANDS] + [OLDEST_BAND]
    return banded.where(F.col("age_band").isNotNull()).groupBy("age_band").agg(
        F.count("*").alias("messages")
    ).withColumn("position", fixed_order(F.col("age_band"), labels))


def messages_per_sender(messages: DataFrame) -> DataFrame:
    """Messages, active senders and messages per active sender, per day."""
    sent = messages.groupBy(F.to_date("time").alias("date"), "user_id").agg(F.count("*").alias("n"))
    return sent.groupBy("date").agg(
        F.sum("n").alias("messages"),
        F.count("user_id").alias("senders"),
        ratio(F.sum("n"), F.count("user_id")).alias("messages_per_sender"),
    )
