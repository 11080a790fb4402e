"""The daily mart, day by day: only new days are read, and the days when entities came first.

The state has one row per post and the day it was first seen, one directory per such day. An
update reads the actions of its days and the posts of the state's earlier days, and replaces
the directories of its own days in the state and the mart. So a repeated update changes
nothing, an update that failed half-way is repeated, and no earlier file is written again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortwise.functions.columns import in_period, ratio
from cohortwise.operators.marts import daily_users, posts_by_day
from cohortwise.session import materialised
from cohortwise.sources.sinks import write_daily_mart

STATE = "post_id string, first_seen date"


def first_seen(spark: SparkSession, path: str) -> DataFrame:
    """The state; without rows before the first update."""
    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE)


def update_daily_mart(
    actions: DataFrame, mart_path: str, state_path: str, start: str, end: str,
    like: str = "like", view: str = "view",
) -> DataFrame:
    """Write the days ``start`` to ``end`` of the mart and the state; returns the days written.

    Days are updated in order, several at once if need be; to replay a day, replay all days
    from it on, else ValueError, since a post may now come first on an earlier day. The columns
    are those of ``daily_mart``. A day that had actions in an earlier update and has none now
    keeps its old directory.
    """
    spark = actions.sparkSession
    first = F.lit(start).cast("date")
    known = first_seen(spark, state_path)
    if not known.where(F.col("first_seen") > F.lit(end).cast("date")).isEmpty():
        raise ValueError(f"the state has days after {end}: update from {start} to the last of them")
    new = actions.where(in_period(F.col("time"), start, end))
    posts = materialised(posts_by_day(new, view))
    # Directories of later days are not read.
    earlier = known.where(F.col("first_seen") < first).select("post_id")
    fresh = materialised(
        posts.groupBy("post_id").agg(F.min("date").alias("first_seen")).join(earlier, "post_id", "left_anti")
    )
    write_daily_mart(fresh.select(F.col("post_id").cast("string").alias("post_id"), "first_seen"), state_path, "first_seen")
    counts = posts.groupBy("date").agg(F.coalesce(F.sum("viewed"), F.lit(0)).alias("unique_viewed_posts"))
    came = fresh.groupBy(F.col("first_seen").alias("date")).agg(F.count("*").alias("new_posts"))
    # Both sides have one row per day.
    mart = daily_users(new, like, view).join(counts, "date", "left").join(came, "date", "left").select(
        "date", "dau", "likes", "views", ratio(F.col("likes"), F.col("views")).alias("ctr"),
        F.coalesce("unique_viewed_posts", F.lit(0)).alias("unique_viewed_posts"),
        F.coalesce("new_posts", F.lit(0)).alias("new_posts"),
    )
    mart = materialised(mart)
    write_daily_mart(mart, mart_path)
    return mart
