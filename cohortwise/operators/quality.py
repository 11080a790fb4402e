"""Data-quality checks. They report; they never delete rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from cohortwise.functions.columns import flag_sum, ratio


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass: ``column_name, rows, nulls``."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[flag_sum(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["_rows"], df.columns, "column_name", "nulls")
    return long.select("column_name", F.col("_rows").alias("rows"), "nulls")


def duplicate_counts(df: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows beyond the first of each key: ``rows, distinct_keys, duplicates``."""
    per_key = df.groupBy(*by, *keys).agg(F.count("*").alias("n"))
    return per_key.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def exact_duplicates(df: DataFrame, tag: str, key: str) -> DataFrame:
    """Per source: rows, rows without key, repeated rows before and after dropping the keyless."""
    values = [c for c in df.columns if c != tag]
    per_row = df.groupBy(tag, *values).agg(F.count("*").alias("n"))
    keyless = F.col(key).isNull()
    return per_row.groupBy(tag).agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(keyless, F.col("n"))), F.lit(0)).alias("missing_key"),
        F.sum(F.col("n") - 1).alias("duplicates_all_rows"),
        F.coalesce(F.sum(F.when(~keyless, F.col("n"))), F.lit(0)).alias("valid_rows"),
        F.coalesce(F.sum(F.when(~keyless, F.col("n") - 1)), F.lit(0)).alias("duplicates_valid_rows"),
    )


def orphan_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows and distinct keys of ``left`` without a partner in ``right``.

    Unlike NOT IN an anti join keeps its meaning when the right side holds nulls. Both
    sides are reduced to one row per key before they are shuffled for the join.
    """
    keys = list(keys)
    per_key = left.groupBy(*keys).agg(F.count("*").alias("n"))
    lonely = per_key.join(right.select(*keys).distinct(), keys, "left_anti")
    return lonely.agg(
        F.lit(name).alias("check"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
        F.count("*").alias("orphan_keys"),
    )


def reconcile(
    users: DataFrame, transactions: DataFrame, keys: Sequence[str], group: str,
    stated: str = "total_revenue", revenue: str = "revenue", tolerance: float = 0.0,
) -> DataFrame:
    """Per group: stated revenue, sum of transactions, users that differ, difference."""
    keys = list(keys)
    summed = transactions.groupBy(*keys).agg(F.sum(revenue).alias("_summed"))
    checked = users.join(summed, keys, "left").withColumn(
        "_summed", F.coalesce("_summed", F.lit(0.0))
    )
    gap = F.abs(F.col("_summed") - F.col(stated))
    return checked.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("users"),
        F.sum(stated).alias("users_revenue"),
        F.sum("_summed").alias("transactions_revenue"),
        flag_sum(gap > tolerance).alias("mismatch_users"),
        (F.sum("_summed") - F.sum(stated)).alias("difference"),
    )


def chronology(
    df: DataFrame, group: str, earlier: Column, later: Column, fmt: str | None = None
) -> DataFrame:
    """Rows per group whose ``later`` time lies before ``earlier``.

    Text is parsed tolerantly: what is not a date becomes null and is never counted as early.
    """
    parse = (lambda c: F.try_to_timestamp(c, F.lit(fmt))) if fmt else F.try_to_timestamp
    first, second = parse(earlier), parse(later)
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("rows"),
        flag_sum(first.isNull() | second.isNull()).alias("unreadable"),
        flag_sum(second < first).alias("before_start"),
    )


def day_gaps(df: DataFrame, day: str, by: Sequence[str] = ()) -> DataFrame:
    """Days between the first and last day that have no row: ``by..., missing_day``.

    Rows are reduced to distinct days first; the calendar has one row per day.
    """
    seen = df.select(*by, F.col(day).cast("date").alias("missing_day")).distinct()
    edges = seen.groupBy(*by).agg(F.min("missing_day").alias("a"), F.max("missing_day").alias("b"))
    spine = edges.select(
        *by, F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("missing_day")
    )
    return spine.join(seen, [*by, "missing_day"], "left_anti")


def day_checks(df: DataFrame, day: str) -> DataFrame:
    """One row: rows, distinct days, duplicated days, missing days, nulls."""
    date = F.col(day).cast("date")
    per_day = df.groupBy(date.alias("_day")).agg(F.count("*").alias("n"))
    span = F.datediff(F.max("_day"), F.min("_day")) + 1
    return per_day.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("_day").alias("days"),
        F.coalesce(F.sum(F.when(F.col("_day").isNotNull(), F.col("n") - 1)), F.lit(0)).alias(
            "duplicate_days"
        ),
        F.coalesce(span - F.count("_day"), F.lit(0)).cast("long").alias("missing_days"),
    )


def ratio_error(df: DataFrame, derived: str, numerator: str, denominator: str) -> DataFrame:
    """Largest absolute gap between a stored ratio and the one recomputed."""
    gap = F.abs(F.col(derived) - ratio(F.col(numerator), F.col(denominator)))
    return df.agg(F.count("*").alias("rows"), F.max(gap).alias("max_error"))


def domain_check(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Each value seen or expected, with its rows and ``ok``, ``unexpected`` or ``absent``."""
    text = F.col(column).cast("string")
    seen = df.groupBy(text.alias("value")).agg(F.count("*").alias("rows"))
    # The expected list is part of the call, not of the data.
    wanted = df.sparkSession.createDataFrame([(str(v),) for v in expected], "value string")
    joined = seen.join(wanted.withColumn("wanted", F.lit(True)), "value", "full_outer")
    status = (
        F.when(F.col("wanted").isNull(), "unexpected")
        .when(F.col("rows").isNull(), "absent")
        .otherwise("ok")
    )
    return joined.select("value", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))


def non_positive(df: DataFrame, column: str) -> DataFrame:
    """Rows whose denominator is null, zero or negative."""
    return df.agg(
        F.count("*").alias("rows"),
        flag_sum(F.col(column).isNull() | (F.col(column) <= 0)).alias("non_positive"),
    )


def shared_users(df: DataFrame, user: str, group: str) -> DataFrame:
    """Users, and users that occur in more than one group."""
    per_user = df.groupBy(user).agg(
        F.min(group).alias("lowest"), F.max(group).alias("highest")
    )
    return per_user.agg(
        F.count("*").alias("users"),
        flag_sum(F.col("lowest") != F.col("highest")).alias("users_in_two_groups"),
    )


def fan_out(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before and after a join, and rows per key beyond the first, in one job."""
    sides = before.select(*keys, F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(*keys, F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    per_key = sides.groupBy(*keys).agg(F.sum("b").alias("b"), F.sum("a").alias("a"))
    return per_key.agg(
        F.sum("b").alias("rows_before"),
        F.sum("a").alias("rows_after"),
        F.sum(F.greatest(F.col("a") - 1, F.lit(0))).alias("repeated_keys"),
    )


def contract(
    df: DataFrame, table: str, schema: StructType, rows: int | None = None
) -> DataFrame:
    """Row count and header against the expected ones. Types are compared by name."""
    header = [f.name for f in df.schema.fields] == schema.fieldNames()
    types = header and [f.dataType.typeName() for f in df.schema.fields] == [
        f.dataType.typeName() for f in schema.fields
    ]
    rows_ok = F.lit(True) if rows is None else F.col("rows") == rows
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(table).alias("table_name"), "rows", F.lit(header).alias("header_ok"),
        F.lit(types).alias("types_ok"), rows_ok.alias("rows_ok"),
    )


def require_zero(checks: DataFrame, columns: Sequence[str]) -> None:
    """Raise ``ValueError`` listing the counts that are not zero. Input: one row of counts."""
    row = checks.select(*columns).first().asDict()
    failed: Mapping[str, object] = {name: value for name, value in row.items() if value}
    if failed:
        listing = ", ".join(f"{name} = {value}" for name, value in failed.items())
        raise ValueError(f"data checks failed: {listing}")


#: How sure the order of ids must be: correlation of ids and dates, and its lead.
ALIKE, LEAD = 0.9, 0.05
DAY_FIRST, MONTH_FIRST, UNDECIDED = "day first", "month first", "undecided"


def _date_of(text: Column, day: int, month: int) -> Column:
    """Date of ``a.b.yyyy`` text (also ``/`` or ``-``); null where it is none."""
    part = lambda k: F.lpad(F.regexp_extract(text, r"^\s*(\d{1,2})[./-](\d{1,2})[./-](\d{4})", k), 2, "0")
    year = F.regexp_extract(text, r"^\s*\d{1,2}[./-]\d{1,2}[./-](\d{4})", 1)
    return F.try_to_date(F.concat_ws("-", year, part(month), part(day)), "yyyy-MM-dd")


def date_orders(rows: DataFrame, file: str, text: str, number: str) -> DataFrame:
    """Whether day or month comes first, per file, from what the dates and their numbers say.

    A number over 12 in one place proves the order. A file with proofs of one kind has that
    order; a file with proofs of both is undecided. Without a proof, dates that rise with the
    payment numbers under one order alone decide: their correlation is at least ``ALIKE`` and
    leads the other's by ``LEAD``. Files are one aggregate each; the result has one row a file.
    Null files form no group.
    """
    day_first, month_first = _date_of(F.col(text), 1, 2), _date_of(F.col(text), 2, 1)
    read = rows.where(F.col(file).isNotNull()).select(
        F.col(file).alias("file"), F.col(number).cast("double").alias("number"),
        day_first.alias("d"), month_first.alias("m"), F.col(text).isNotNull().alias("told"),
    )
    days = lambda c: F.when(F.col("d").isNotNull() & F.col("m").isNotNull(), F.unix_date(c)).cast("double")
    found = read.groupBy("file").agg(
        F.count_if("told").alias("dates"), F.count_if(F.col("d").isNull() & F.col("m").isNull() & F.col("told")).alias("unreadable"),
        F.count_if(F.col("d").isNotNull() & F.col("m").isNull()).alias("day_proofs"),
        F.count_if(F.col("d").isNull() & F.col("m").isNotNull()).alias("month_proofs"),
        F.corr("number", days("d")).alias("day_fit"), F.corr("number", days("m")).alias("month_fit"),
    )
    proof = lambda c: F.col(f"{c}_proofs") > 0
    fits = lambda a, b: (F.col(a) >= ALIKE) & (F.col(a) >= F.coalesce(F.col(b), F.lit(-1.0)) + LEAD)
    none = ~proof("day") & ~proof("month")
    order = (
        F.when(proof("day") & ~proof("month"), DAY_FIRST).when(proof("month") & ~proof("day"), MONTH_FIRST)
        .when(none & fits("day_fit", "month_fit"), DAY_FIRST).when(none & fits("month_fit", "day_fit"), MONTH_FIRST)
        .otherwise(UNDECIDED)
    )
    return found.withColumn("order", order)


def dated(rows: DataFrame, orders: DataFrame, file: str, text: str, into: str = "date") -> DataFrame:
    """Adds the date under the file's order. Of an undecided file only dates that read the same
    under both orders are told; all others stay null, to be counted, not guessed."""
    d, m = _date_of(F.col(text), 1, 2), _date_of(F.col(text), 2, 1)
    # One row per file.
    joined = rows.join(orders.select(F.col("file").alias(file), F.col("order").alias("_order")), file, "left")
    value = (
        F.when(F.col("_order") == DAY_FIRST, d).when(F.col("_order") == MONTH_FIRST, m).otherwise(F.when(d == m, d))
    )
    return joined.withColumn(into, value).select(*rows.columns, into)


def date_order_report(rows: DataFrame, file: str, text: str, number: str) -> DataFrame:
    """Per file: its order, what decided it, and how many dates could be told."""
    orders = date_orders(rows, file, text, number)
    told = dated(rows, orders, file, text, "_date").where(F.col(file).isNotNull()).groupBy(F.col(file).alias("file")).agg(
        F.count("_date").alias("told")
    )
    return orders.join(told, "file").select(
        "file", "order", "dates", "told", "unreadable", "day_proofs", "month_proofs", "day_fit", "month_fit"
    )
