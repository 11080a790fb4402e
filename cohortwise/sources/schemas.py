"""Explicit schemas of the input tables. Nothing is inferred from file contents."""

from pyspark.sql.types import StructType


def table_schema(**columns: str) -> StructType:
    """Schema from column names and type names; needs no running session."""
    schema = StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


REGISTRATIONS = table_schema(reg_ts="long", uid="long")
AUTHORIZATIONS = table_schema(auth_ts="long", uid="long")
AB_REVENUE = table_schema(user_id="long", revenue="double", testgroup="string")
GROUPS = table_schema(student_id="long", grp="string")
POPULATION = table_schema(student_id="long")
CHECKS = table_schema(student_id="long", rev="double")
USERS = table_schema(
    uid="long", age="double", attraction_coeff="double", views_count="double",
    country="string", gender="string", total_revenue="double",
)
# Ids arrive as decimals because the column has gaps; they are cast after the gaps are removed.
TRANSACTIONS = table_schema(
    uid="double", payment_id="double", product_type="string", revenue="double",
    country="string", joined_at="string", paid_at="string",
)
CUSTOMERS = table_schema(customer_id="long", customer_city="string", created_at="timestamp_ntz")
ORDERS = table_schema(
    customer_id="long", order_status="string", order_created_time="timestamp_ntz",
    order_delivered_customer_time="timestamp_ntz",
)
CUSTOMER_ACTIONS = table_schema(customer_id="long", event_type="string")
FEED_ACTIONS = table_schema(
    time="timestamp_ntz", user_id="long", post_id="long", action="string", exp_group="integer"
)
MESSAGES = table_schema(time="timestamp_ntz", user_id="long", gender="string", age="integer")
DAILY_METRICS = table_schema(
    date="date", dau="long", likes="long", views="long", ctr="double",
    unique_viewed_posts="long", new_posts="long",
)
