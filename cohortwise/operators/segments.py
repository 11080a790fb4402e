"""Customer segmentation from orders and actions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortwise.functions.columns import flag_sum

# Segment names, order status and event type of the segmentation.
REGULAR, ONE_OFF, INACTIVE, NEW = "Постоянный", "Разовый", "Неактивный", "Новый"
DELIVERED, PURCHASE = "Delivered", "Purchase"


def days_between(start: Column, end: Column) -> Column:
    """Elapsed days with fractions, from whole seconds."""
    return F.timestamp_diff("SECOND", start, end) / F.lit(86400.0)


def delivered_orders(orders: DataFrame, status: str = DELIVERED) -> DataFrame:
    """Delivered orders and mean delivery days per customer."""
    delivered = F.col("order_status") == status
    took = days_between(F.col("order_created_time"), F.col("order_delivered_customer_time"))
    return orders.groupBy("customer_id").agg(
        flag_sum(delivered).alias("orders_count"),
        F.avg(F.when(delivered, took)).alias("avg_delivery_days"),
    )


def purchase_events(actions: DataFrame, event: str = PURCHASE) -> DataFrame:
    return actions.groupBy("customer_id").agg(
        flag_sum(F.col("event_type") == event).alias("purchase_events_count")
    )


def customer_segments(
    customers: DataFrame, orders: DataFrame, actions: DataFrame, as_of: str,
    delivered: str = DELIVERED, purchase: str = PURCHASE,
) -> DataFrame:
    """Segment per customer on the day ``as_of``.

    Orders and actions are reduced to the customer before the joins; joining the raw
    tables would multiply rows and inflate counts and means.
    """
    day = F.to_date("created_at")
    age = F.datediff(F.lit(as_of).cast("date"), day)
    n_orders = F.coalesce("orders_count", F.lit(0))
    segment = (
        F.when(n_orders >= 3, REGULAR)
        .when(n_orders.between(1, 2), ONE_OFF)
        .when(age > 30, INACTIVE)
        .otherwise(NEW)
    )
    # The decimal cast makes ties round away from zero on the exact value.
    rounded = F.round(F.col("avg_delivery_days").cast("decimal(20,6)"), 2)
    return (
        customers.join(delivered_orders(orders, delivered), "customer_id", "left")
        .join(purchase_events(actions, purchase), "customer_id", "left")
        .select(
            "customer_id",
            "customer_city",
            day.alias("registration_date"),
            age.alias("days_since_registration"),
            n_orders.alias("orders_count"),
            F.coalesce("purchase_events_count", F.lit(0)).alias("purchase_events_count"),
            rounded.cast("double").alias("avg_delivery_days"),
            segment.alias("segment"),
        )
    )
