"""Day-N retention by registration cohort."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from cohortwise.functions.columns import flag_sum, in_days, ratio, require_columns, unix_day

REGISTRATION = ("reg_ts", "uid")
AUTHORIZATION = ("auth_ts", "uid")


def _epoch(day) -> int:
    moment = datetime.fromisoformat(str(day)[:10]).replace(tzinfo=timezone.utc)
    return int(moment.timestamp())


def _fail(message: str, kind: str) -> Column:
    return F.raise_error(F.lit(message)).cast(kind)


def _strict_day(seconds: str, uid: str = "uid") -> Column:
    """UTC day; a missing user or an unusable time stamp fails the job."""
    day = unix_day(F.col(seconds))
    return (
        F.when(F.col(uid).isNull(), _fail("uid must not be null", "date"))
        .when(day.isNull(), _fail(f"{seconds} holds null or non-numeric values", "date"))
        .otherwise(day)
    )


def _cohorts(registrations: DataFrame, by: Sequence[str], start, end) -> DataFrame:
    """One row per user. A user registered twice fails the job.

    The uniqueness check rides on the shuffle by uid that the join needs anyway.
    """
    uid = F.coalesce("uid", _fail("uid must not be null", registrations.schema["uid"].dataType.simpleString()))
    # The explicit filter keeps the two uses of this table alike, so its shuffle is reused.
    named = registrations.withColumn("uid", uid).where(F.col("uid").isNotNull())
    once = named.groupBy("uid").agg(
        F.count("*").alias("_rows"), F.min("reg_ts").alias("reg_ts"),
        *[F.max(c).alias(c) for c in by],
    )
    day = (
        F.when(F.col("_rows") > 1, _fail("uid must occur exactly once in registrations", "date"))
        .otherwise(_strict_day("reg_ts"))
    )
    cohorts = once.select("uid", *by, day.alias("cohort_date"))
    cohorts = cohorts.where(in_days(F.col("cohort_date"), start, end))
    for column in by:
        cohorts = cohorts.where(F.col(column).isNotNull())
    return cohorts


def check_inputs(registrations: DataFrame, authorizations: DataFrame, start=None, end=None) -> None:
    """Raise ``ValueError`` before the job starts: two aggregates, one per table."""
    reg_day, auth_day = unix_day(F.col("reg_ts")), unix_day(F.col("auth_ts"))
    per_user = registrations.groupBy("uid").agg(
        F.count("*").alias("rows"),
        flag_sum(reg_day.isNull()).alias("bad"),
        flag_sum(in_days(reg_day, start, end)).alias("kept"),
    )
    reg = per_user.agg(
        flag_sum(F.col("uid").isNull()).alias("null_uid"),
        flag_sum(F.col("rows") > 1).alias("repeated"),
        F.sum("bad").alias("bad"),
        F.sum("kept").alias("kept"),
    ).first()
    auth = authorizations.agg(
        flag_sum(F.col("uid").isNull()).alias("null_uid"), flag_sum(auth_day.isNull()).alias("bad")
    ).first()
    if reg.null_uid or auth.null_uid:
        raise ValueError("uid must not be null")
    if reg.repeated:
        raise ValueError(f"uid must occur exactly once in registrations: {reg.repeated} repeated")
    if reg.bad or auth.bad:
        raise ValueError("time stamps hold null or non-numeric values")
    if not reg.kept:
        raise ValueError("no registration cohort is left after filtering")


def calculate_retention(
    registrations: DataFrame, authorizations: DataFrame,
    start_date: str | date | None = None, end_date: str | date | None = None,
    max_days: int = 14, *, as_percent: bool = False, mask_incomplete: bool = True,
    by: Sequence[str] = (), check_now: bool = False,
) -> DataFrame:
    """Share of a cohort active on exactly day N after registration, N = 0..max_days.

    Long form: ``cohort_date, day, cohort_size, active, retention, observation_end``, plus
    the columns ``by`` of the registrations. Cells after the last authorization day of the
    whole table are null when ``mask_incomplete``, else zero. Broken input fails the job
    while it runs; ``check_now`` spends two extra aggregates to raise ``ValueError`` at once.
    """
    if isinstance(max_days, bool) or not isinstance(max_days, int) or max_days < 0:
        raise ValueError("max_days must be a non-negative whole number")
    by = list(by)
    require_columns(registrations, [*REGISTRATION, *by], "registrations")
    require_columns(authorizations, AUTHORIZATION, "authorizations")
    if check_now:
        check_inputs(registrations, authorizations, start_date, end_date)

    cohorts = _cohorts(registrations.select("uid", "reg_ts", *by), by, start_date, end_date)
    sizes = cohorts.groupBy(*by, "cohort_date").agg(F.count("*").alias("cohort_size"))

    # Only days a kept cohort can reach; on a numeric column the range reaches the scan.
    reachable = authorizations.select("uid", "auth_ts")
    if isinstance(authorizations.schema["auth_ts"].dataType, NumericType):
        if start_date is not None:
            reachable = reachable.where(F.col("auth_ts") >= _epoch(start_date))
        if end_date is not None:
            last = _epoch(end_date) + int(timedelta(days=max_days + 1).total_seconds())
            reachable = reachable.where(F.col("auth_ts") < last)
    # One row per user and day before the join: a very active user shrinks on the map side.
    days = reachable.select("uid", unix_day(F.col("auth_ts")).alias("auth_date")).distinct()
    active = (
        days.join(cohorts, "uid")
        .withColumn("day", F.datediff("auth_date", "cohort_date"))
        .where(F.col("day").between(0, max_days))
        .groupBy(*by, "cohort_date", "day")
        .agg(F.count("*").alias("active"))
    )
    grid = sizes.withColumn("day", F.explode(F.sequence(F.lit(0), F.lit(max_days))))
    # Last day of ALL authorizations, before any cohort filter: one value, used as a scalar.
    observed = authorizations.agg(F.max(_strict_day("auth_ts")).alias("end")).scalar()
    share = ratio(F.col("active"), F.col("cohort_size")) * (100.0 if as_percent else 1.0)
    if mask_incomplete:
        unseen = F.date_add("cohort_date", F.col("day")) > F.col("observation_end")
        share = F.when(F.coalesce(unseen, F.lit(False)), F.lit(None)).otherwise(share)
    return (
        grid.join(active, [*by, "cohort_date", "day"], "left")
        .withColumn("active", F.coalesce("active", F.lit(0)))
        .withColumn("observation_end", observed)
        .select(
            *by, "cohort_date", "day", "cohort_size", "active",
            share.alias("retention"), "observation_end",
        )
    )


def retention_matrix(retention: DataFrame, max_days: int, by: Sequence[str] = ()) -> DataFrame:
    """Wide form: one column ``d0..dN`` per day."""
    days = list(range(max_days + 1))
    wide = (
        retention.groupBy(*by, "cohort_date", "cohort_size")
        .pivot("day", days).agg(F.first("retention"))
    )
    return wide.select(
        *by, "cohort_date", "cohort_size", *[F.col(str(d)).alias(f"d{d}") for d in days]
    )


def weighted_retention(
    retention: DataFrame, days: Sequence[int] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Retention over all cohorts, weighted by size; masked cells count on neither side."""
    seen = retention.where(F.col("retention").isNotNull())
    if days is not None:
        seen = seen.where(F.col("day").isin(list(days)))
    return seen.groupBy(*by, "day").agg(
        F.sum("cohort_size").alias("users"),
        ratio(
            F.sum(F.col("retention") * F.col("cohort_size")), F.sum("cohort_size")
        ).alias("weighted_retention"),
    )


def retention_checks(registrations: DataFrame, authorizations: DataFrame) -> DataFrame:
    """One row of counts: repeated and null users, orphan and early authorizations, users without D0."""
    reg = registrations.groupBy("uid").agg(
        F.count("*").alias("reg_rows"), F.min(unix_day(F.col("reg_ts"))).alias("cohort_date")
    )
    days = authorizations.groupBy("uid", unix_day(F.col("auth_ts")).alias("auth_date")).agg(
        F.count("*").alias("rows")
    )
    # Per user first, so that the outer join meets one row per user on both sides.
    joined = days.join(reg, "uid", "full_outer")
    per_user = joined.groupBy("uid").agg(
        F.max("reg_rows").alias("reg_rows"),
        F.sum("rows").alias("rows"),
        F.sum(F.when(F.col("auth_date") < F.col("cohort_date"), F.col("rows"))).alias("early"),
        F.max((F.col("auth_date") == F.col("cohort_date")).cast("int")).alias("d0"),
    )
    registered = F.col("reg_rows").isNotNull()
    return per_user.agg(
        flag_sum(registered).alias("registered_users"),
        flag_sum(F.col("reg_rows") > 1).alias("repeated_users"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("authorizations"),
        F.coalesce(F.sum(F.when(~registered, F.col("rows"))), F.lit(0)).alias(
            "orphan_authorizations"
        ),
        F.coalesce(F.sum("early"), F.lit(0)).alias("early_authorizations"),
        flag_sum(registered & (F.coalesce("d0", F.lit(0)) == 0)).alias("users_without_d0"),
    )
