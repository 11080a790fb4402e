"""The roles of the analyses, taken from the given tables.

Each function maps whole tables to the columns an operator expects. Experiment arms are
assigned from the user key; no rows are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortwise.operators.experiment import PREMIUM, TRIAL

EXPERIMENT_START = "2001-01-01"
ARMS = ("control_1", "control_2", "test")
LARGE_PURCHASE = 150.0


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def arm_of(key: Column) -> Column:
    """Three arms."""
    part = F.pmod(key, F.lit(3))
    return F.when(part == 0, ARMS[0]).when(part == 1, ARMS[1]).otherwise(ARMS[2])


def ab_users(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user: revenue of large purchases, arm a or b."""
    paid = (F.col("event_type") == "purchase") & (F.col("value") > LARGE_PURCHASE)
    return (
        events(spark, folder)
        .groupBy("user_id")
        .agg(F.coalesce(F.sum(F.when(paid, F.col("value"))), F.lit(0.0)).alias("revenue"))
        .withColumn("testgroup", F.when(F.pmod("user_id", F.lit(2)) == 0, "a").otherwise("b"))
    )


def registrations(spark: SparkSession, folder: str) -> DataFrame:
    """First purchase as the registration."""
    return (
        events(spark, folder)
        .where(F.col("event_type") == "purchase")
        .groupBy("user_id")
        .agg(F.min("ts").alias("ts"))
        .select(F.unix_seconds(F.col("ts").cast("timestamp")).alias("reg_ts"), F.col("user_id").alias("uid"))
    )


def authorizations(spark: SparkSession, folder: str) -> DataFrame:
    """All events as visits."""
    return events(spark, folder).select(
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("auth_ts"), F.col("user_id").alias("uid")
    )


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks as likes; a post is the user's item number."""
    kind = F.col("event_type")
    return events(spark, folder).select(
        F.col("ts").alias("time"),
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.get_json_object("props", "$.k")).alias("post_id"),
        F.when(kind == "click", "like").otherwise(kind).alias("action"),
        (F.pmod("user_id", F.lit(2)) + 1).cast("int").alias("exp_group"),
    )


def activity(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the column names of the engagement operators and a numeric level."""
    return events(spark, folder).select(
        "event_id",
        F.col("ts").alias("time"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("level"),
    )


def spending(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as money spent in the game."""
    return events(spark, folder).where(F.col("event_type") == "purchase").select(
        F.col("ts").alias("time"), "user_id", "value"
    )


def dated_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as payments of five files that write dates as text in their own ways.

    0 and 1 have one order each, 2 and 3 the same with early days of the month alone, of which
    3 has numbers that follow no date, and 4 mixes both.
    """
    orders = table(spark, folder, "orders")
    kind, day = F.pmod("o_custkey", F.lit(5)), F.dayofmonth("o_orderdate")
    month_first = (kind == 1) | (kind == 4) & (F.pmod("o_orderkey", F.lit(2)) == 0)
    text = F.when(month_first, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "dd.MM.yyyy"))
    early = ~kind.isin(2, 3) | (day <= 12)
    number = F.when(kind == 3, F.col("o_orderkey")).otherwise(F.unix_date(F.to_date("o_orderdate")))
    return orders.select(
        F.concat(F.lit("file_"), kind.cast("string")).alias("file"), number.cast("long").alias("payment_id"),
        F.when(early, text).alias("paid_at"),
    )


def services(spark: SparkSession, folder: str) -> DataFrame:
    """Views and clicks belong to the feed, purchases above 100 to the messenger."""
    kind = F.col("event_type")
    service = F.when(kind.isin("view", "click"), "feed").when(
        (kind == "purchase") & (F.col("value") > 100), "messenger"
    )
    return events(spark, folder).select(F.col("ts").alias("time"), "user_id", service.alias("service"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases as messages."""
    sent = events(spark, folder).where(F.col("event_type") == "purchase")
    return sent.select(
        F.col("ts").alias("time"), "user_id", (F.pmod("user_id", F.lit(50)) + 15).cast("int").alias("age")
    )


def senders(spark: SparkSession, folder: str) -> DataFrame:
    """Gender of a sender: the market segment of the same key."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("gender")
    )


def _countries(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey)


def customer_countries(spark: SparkSession, folder: str) -> DataFrame:
    return _countries(spark, folder).select(F.col("c_custkey").alias("uid"), F.col("n_name").alias("country"))


def experiment_users(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with arm, features known before the start, and revenue since the start."""
    orders = table(spark, folder, "orders")
    since = F.col("o_orderdate") >= F.lit(EXPERIMENT_START).cast("timestamp_ntz")
    per_customer = orders.groupBy(F.col("o_custkey").alias("uid")).agg(
        F.count_if(~since).alias("views_count"),
        F.sum(F.when(since, F.col("o_totalprice"))).alias("total_revenue"),
    )
    people = _countries(spark, folder).select(
        F.col("c_custkey").alias("uid"),
        arm_of(F.col("c_custkey")).alias("group"),
        (F.pmod("c_custkey", F.lit(50)) + 15).cast("double").alias("age"),
        F.col("c_acctbal").alias("attraction_coeff"),
        F.col("n_name").alias("country"),
        F.col("c_mktsegment").alias("gender"),
    )
    return (
        people.join(per_customer, "uid", "left")
        .withColumn("views_count", F.coalesce("views_count", F.lit(0)).cast("double"))
        .withColumn("total_revenue", F.coalesce("total_revenue", F.lit(0.0)))
    )


def experiment_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Orders since the start, with product type from the priority and payment system from the status."""
    orders = table(spark, folder, "orders").where(
        F.col("o_orderdate") >= F.lit(EXPERIMENT_START).cast("timestamp_ntz")
    )
    priority = F.col("o_orderpriority")
    product = F.when(priority == "1-URGENT", PREMIUM).when(priority == "5-LOW", TRIAL).otherwise("other")
    return orders.select(
        F.col("o_custkey").alias("uid"),
        arm_of(F.col("o_custkey")).alias("group"),
        product.alias("product_type"),
        F.col("o_orderstatus").alias("payment_system"),
        F.col("o_totalprice").alias("revenue"),
    )


def segment_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers, orders and actions of the segmentation.

    The last order stands for the registration, status F for delivery, the first shipping
    date for its time.
    """
    orders = table(spark, folder, "orders")
    shipped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("order_delivered_customer_time")
    )
    joined = orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "Delivered").otherwise(F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderdate").alias("order_created_time"),
        "order_delivered_customer_time",
    )
    created = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("created_at"))
    customers = (
        _countries(spark, folder)
        .join(created, "c_custkey", "left")
        .select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("customer_city"), "created_at")
    )
    actions = events(spark, folder).select(
        F.col("user_id").alias("customer_id"),
        F.when(F.col("event_type") == "purchase", "Purchase").otherwise(F.col("event_type")).alias("event_type"),
    )
    return customers, joined, actions
