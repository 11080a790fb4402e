"""One registered query per operator. Results are rounded only here, for comparison."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from cohortwise.functions.columns import hash_bucket
from cohortwise.operators import (
    assignment, bootstrap, charts, contingency, ctr, effects, engagement, experiment, incremental, intervention, lifetime, marts,
    progress, quality, rank_tests, retention, segments, structural, tails,
)
from cohortwise.plans import inputs
from cohortwise.session import configure, materialised, shared_folder
from cohortwise.sources.readers import read_delimited, tag_union

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CTR_START, CTR_END = "2024-01-01", "2024-01-31"
MART_END = "2024-02-01 00:00:00"
PRE, POST = ("2024-01-01", "2024-01-20"), ("2024-01-21", "2024-01-27")
BUCKETS = 10
REPLICATES = 2000
SEGMENT_DAY = "2001-08-01"
RETENTION = ("2024-01-01", "2024-01-31", 28)
FUNNEL = ("view", "click", "purchase")


def query(name: str):
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(configure(spark), folder)

        QUERIES[name] = run
        return run

    return register


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Whole numbers as long, doubles rounded; ``special`` sets the digits of single columns."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, DoubleType):
            column = F.round(column, special.get(field.name, digits))
        elif isinstance(field.dataType, IntegerType):
            column = column.cast("long")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# ---- experiment tables and metrics ---------------------------------------------------------


@query("ab_metrics")
def ab_metrics(spark, folder):
    users = inputs.ab_users(spark, folder)
    return tidy(experiment.group_metrics(users, "testgroup", "revenue"), revenue=2, arpu=4, arppu=4)


def user_experiment(spark, folder) -> DataFrame:
    users = inputs.experiment_users(spark, folder)
    bought = experiment.valid_transactions(inputs.experiment_transactions(spark, folder))
    return experiment.product_user_table(users, bought)


@query("exp_user")
def exp_user(spark, folder):
    return tidy(user_experiment(spark, folder), 2)


@query("exp_union")
def exp_union(spark, folder):
    orders = inputs.table(spark, folder, "orders")
    files = {
        tag: orders.where(F.col("o_orderstatus") == status).select("o_orderkey", "o_custkey", "o_totalprice")
        for tag, status in zip(inputs.ARMS, ("F", "O", "P"))
    }
    return tidy(tag_union(files), 2)


@query("src_csv")
def src_csv(spark, folder):
    """Orders written as delimited files and read back with a fixed schema."""
    orders = inputs.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"), F.to_date("o_orderdate").alias("order_date"),
    )
    place = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    orders.write.csv(place, sep=";", header=True)
    schema = StructType.fromDDL(
        "order_id long, customer_id long, status string, price double, order_date date"
    )
    return tidy(read_delimited(spark, place, schema), 2)


@query("ab_product")
def ab_product(spark, folder):
    metrics = experiment.product_metrics(user_experiment(spark, folder), "group")
    return tidy(metrics, 4, conversion=6, premium_conversion=6, trial_conversion=6, revenue=2, premium_revenue=2)


@query("ab_pooled")
def ab_pooled(spark, folder):
    users = experiment.pooled(user_experiment(spark, folder))
    metrics = experiment.product_metrics(users, "comparison")
    return tidy(metrics, 4, conversion=6, premium_conversion=6, trial_conversion=6, revenue=2, premium_revenue=2)


@query("late_assign")
def late_assign(spark, folder):
    """Customers of one market segment are assigned anew by a later batch."""
    people = inputs.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("student_id"),
        F.when(F.pmod("c_custkey", F.lit(2)) == 0, "A").otherwise("B").alias("grp"),
        "c_mktsegment",
    )
    late = people.where(F.col("c_mktsegment") == "BUILDING").select("student_id", F.lit("B").alias("grp"))
    checks = inputs.experiment_transactions(spark, folder).select(
        F.col("uid").alias("student_id"), F.col("revenue").alias("rev")
    )
    metrics = experiment.recalculate_metrics(
        people.select("student_id", "grp"), late, people.select("student_id"), checks
    )
    return tidy(metrics, 4, cr=6, revenue=2)


@query("whale_share")
def whale_share(spark, folder):
    return tidy(experiment.large_payers(inputs.ab_users(spark, folder), "testgroup", "revenue", 400.0))


@query("pay_spike")
def pay_spike(spark, folder):
    """Users whose revenue rounds to 400, per arm."""
    return tidy(experiment.payment_spike(inputs.ab_users(spark, folder), "testgroup", "revenue", 400.0))


@query("payer_stats")
def payer_stats(spark, folder):
    return tidy(experiment.payer_statistics(inputs.ab_users(spark, folder), "testgroup", "revenue"), 4)


@query("price_payment")
def price_payment(spark, folder):
    premium = inputs.experiment_transactions(spark, folder).where(F.col("product_type") == experiment.PREMIUM)
    return tidy(experiment.price_by(premium, ["group", "payment_system"]), 4)


@query("price_country")
def price_country(spark, folder):
    """Premium prices in one payment system, so that the ratio compares like with like."""
    bought = inputs.experiment_transactions(spark, folder).where(
        (F.col("product_type") == experiment.PREMIUM) & (F.col("payment_system") == "O")
    ).join(inputs.customer_countries(spark, folder), "uid")
    prices = experiment.price_by_country(experiment.pooled(bought))
    return tidy(prices, 4).orderBy(F.desc_nulls_last("price_ratio"))


@query("cust_segment")
def cust_segment(spark, folder):
    tables = inputs.segment_tables(spark, folder)
    return tidy(segments.customer_segments(*tables, SEGMENT_DAY), 2).orderBy("customer_id")


# ---- retention -----------------------------------------------------------------------------


def _retention(spark, folder, **options) -> DataFrame:
    start, end, days = RETENTION
    return retention.calculate_retention(
        inputs.registrations(spark, folder), inputs.authorizations(spark, folder), start, end, days, **options
    )


@query("retention")
def retention_long(spark, folder):
    return tidy(_retention(spark, folder, as_percent=True), 4)


@query("retention_wide")
def retention_wide(spark, folder):
    long = _retention(spark, folder, as_percent=True, mask_incomplete=False)
    return tidy(retention.retention_matrix(long, RETENTION[2]), 2)


@query("retention_weighted")
def retention_weighted(spark, folder):
    return tidy(retention.weighted_retention(_retention(spark, folder), [0, 1, 7, 14]))


@query("retention_dq")
def retention_dq(spark, folder):
    return tidy(retention.retention_checks(
        inputs.registrations(spark, folder), inputs.authorizations(spark, folder)
    ))


@query("retention_by")
def retention_by(spark, folder):
    """Retention by market segment as the acquisition channel, up to day 30."""
    channel = inputs.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("uid"), F.col("c_mktsegment").alias("channel")
    )
    reg = inputs.registrations(spark, folder).join(channel, "uid")
    long = retention.calculate_retention(
        reg, inputs.authorizations(spark, folder), max_days=30, by=["channel"]
    )
    return tidy(retention.weighted_retention(long, by=["channel"]))


# ---- click-through rate --------------------------------------------------------------------


def feed_users(spark, folder) -> DataFrame:
    return ctr.user_ctr(inputs.feed(spark, folder), CTR_START, CTR_END, [1, 2])


def kept_feed_users(spark, folder) -> DataFrame:
    """The same, computed once for jobs that read the user table more than once."""
    return materialised(feed_users(spark, folder))


@query("user_ctr")
def user_ctr(spark, folder):
    return tidy(feed_users(spark, folder))


@query("ctr_summary")
def ctr_summary(spark, folder):
    return tidy(ctr.ctr_summary(kept_feed_users(spark, folder)))


@query("ctr_effect")
def ctr_effect(spark, folder):
    return tidy(ctr.ctr_effect(feed_users(spark, folder), 1, 2))


@query("ctr_distribution")
def ctr_distribution(spark, folder):
    return tidy(ctr.ctr_distribution(kept_feed_users(spark, folder), 0.8, 1.25))


@query("ctr_smoothed")
def ctr_smoothed(spark, folder):
    return tidy(ctr.smoothed_ctr(kept_feed_users(spark, folder)))


@query("ctr_buckets")
def ctr_buckets(spark, folder):
    return tidy(ctr.bucket_ctr(kept_feed_users(spark, folder), BUCKETS, method="md5"))


@query("ctr_bucket_summary")
def ctr_bucket_summary(spark, folder):
    return tidy(ctr.bucket_summary(ctr.bucket_ctr(kept_feed_users(spark, folder), BUCKETS, method="md5")))


# ---- marts and dashboard -------------------------------------------------------------------


@query("daily_mart")
def daily_mart(spark, folder):
    return tidy(marts.daily_mart(inputs.feed(spark, folder), MART_END))


@query("new_entities")
def new_entities(spark, folder):
    return tidy(marts.new_entities(inputs.feed(spark, folder), "post_id", "time"))


@query("dau_service")
def dau_service(spark, folder):
    return tidy(marts.dau_by_service(inputs.services(spark, folder)))


@query("service_overlap")
def service_overlap(spark, folder):
    in_range = marts.period(inputs.services(spark, folder), "time", "2024-01-01", "2024-01-31")
    return tidy(marts.service_overlap(in_range))


@query("msgs_gender")
def msgs_gender(spark, folder):
    return tidy(marts.messages_by_gender(inputs.messages(spark, folder), inputs.senders(spark, folder)))


@query("msgs_age")
def msgs_age(spark, folder):
    return tidy(marts.messages_by_age(inputs.messages(spark, folder))).orderBy("position")


@query("msgs_per_sender")
def msgs_per_sender(spark, folder):
    return tidy(marts.messages_per_sender(inputs.messages(spark, folder)))


# ---- data quality --------------------------------------------------------------------------


@query("dq_nulls")
def dq_nulls(spark, folder):
    """Customers with the revenue since the start, null where they bought nothing."""
    paid = inputs.experiment_transactions(spark, folder).groupBy("uid").agg(F.sum("revenue").alias("revenue"))
    people = inputs.table(spark, folder, "customer").select(F.col("c_custkey").alias("uid"), "c_name", "c_acctbal")
    return tidy(quality.null_counts(people.join(paid, "uid", "left")))


@query("dq_dups")
def dq_dups(spark, folder):
    return tidy(quality.duplicate_counts(
        inputs.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_returnflag"]
    ))


@query("dq_exact_dups")
def dq_exact_dups(spark, folder):
    """Orders by status, urgent ones entered twice, unspecified ones without a customer."""
    orders = inputs.table(spark, folder, "orders").withColumn(
        "uid", F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey"))
    ).drop("o_custkey")
    journal = orders.unionByName(orders.where(F.col("o_orderpriority").isin("1-URGENT", "4-NOT SPECIFIED")))
    return tidy(quality.exact_duplicates(journal, "o_orderstatus", "uid"))


@query("dq_orphans")
def dq_orphans(spark, folder):
    people = inputs.table(spark, folder, "customer").select(F.col("c_custkey").alias("uid"))
    bought = inputs.experiment_transactions(spark, folder).select("uid")
    active = inputs.events(spark, folder).select(F.col("user_id").alias("uid"))
    checks = [
        quality.orphan_counts(people, bought, ["uid"], "customers_without_purchase"),
        quality.orphan_counts(bought, active, ["uid"], "buyers_without_activity"),
        quality.orphan_counts(active, people, ["uid"], "active_without_customer"),
    ]
    return tidy(checks[0].unionByName(checks[1]).unionByName(checks[2]))


@query("dq_reconcile")
def dq_reconcile(spark, folder):
    """Revenue of all orders per customer against the journal without pending orders."""
    orders = inputs.table(spark, folder, "orders")
    users = orders.groupBy(F.col("o_custkey").alias("uid")).agg(F.sum("o_totalprice").alias("total_revenue"))
    journal = orders.where(F.col("o_orderstatus") != "P").select(
        F.col("o_custkey").alias("uid"), F.col("o_totalprice").alias("revenue")
    )
    return tidy(quality.reconcile(
        users.withColumn("group", inputs.arm_of(F.col("uid"))), journal, ["uid"], "group", tolerance=0.005
    ), 2)


@query("dq_chronology")
def dq_chronology(spark, folder):
    """Shipping before ordering, with day and month swapped in part of the text dates."""
    lines = inputs.table(spark, folder, "lineitem").select("l_orderkey", "l_linestatus", "l_returnflag", "l_shipdate")
    orders = inputs.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    text = F.when(
        F.col("l_linestatus") == "F", F.date_format("l_shipdate", "yyyy-dd-MM")
    ).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    journal = lines.join(orders, "l_orderkey").select(
        "l_returnflag", F.date_format("o_orderdate", "yyyy-MM-dd").alias("joined_at"), text.alias("paid_at")
    )
    return tidy(quality.chronology(
        journal, "l_returnflag", F.col("joined_at"), F.col("paid_at")
    ))


@query("dq_missing_days")
def dq_missing_days(spark, folder):
    return tidy(quality.day_gaps(inputs.events(spark, folder), "ts", ["user_id"]))


@query("dq_days")
def dq_days(spark, folder):
    return tidy(quality.day_checks(inputs.table(spark, folder, "orders"), "o_orderdate"))


@query("dq_ratio")
def dq_ratio(spark, folder):
    mart = marts.daily_mart(inputs.feed(spark, folder), MART_END)
    stored = mart.withColumn("ctr", F.round("ctr", 3))
    return tidy(quality.ratio_error(stored, "ctr", "likes", "views"), 8)


@query("dq_domain")
def dq_domain(spark, folder):
    expected = ["view", "click", "purchase", "refund"]
    return tidy(quality.domain_check(inputs.events(spark, folder), "event_type", expected))


@query("dq_denominator")
def dq_denominator(spark, folder):
    return tidy(quality.non_positive(inputs.table(spark, folder, "customer"), "c_acctbal"))


@query("dq_user_unique_group")
def dq_user_unique_group(spark, folder):
    return tidy(quality.shared_users(inputs.table(spark, folder, "orders"), "o_custkey", "o_orderstatus"))


@query("dq_fanout")
def dq_fanout(spark, folder):
    return tidy(quality.fan_out(
        inputs.experiment_users(spark, folder), user_experiment(spark, folder), ["group", "uid"]
    ))


@query("dq_contract")
def dq_contract(spark, folder):
    expected = {
        "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
        "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "nation": "n_nationkey long, n_name string, n_regionkey long",
        "region": "r_key int, r_name string",
    }
    checks = [
        quality.contract(inputs.table(spark, folder, name), name, StructType.fromDDL(ddl), rows)
        for (name, ddl), rows in zip(expected.items(), (None, None, 25, 5))
    ]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return tidy(out)


@query("srm")
def srm(spark, folder):
    people = inputs.table(spark, folder, "customer")
    shares = {name: 1 for name in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")}
    return tidy(contingency.sample_ratio(people, "c_mktsegment", shares))


# ---- statistics ----------------------------------------------------------------------------


def _ab_pairs(spark, folder) -> DataFrame:
    revenue = F.col("revenue")
    metrics = {
        "conversion": (revenue > 0),
        "arpu": revenue,
        "arppu": F.when(revenue > 0, revenue),
    }
    summary = effects.summarise(inputs.ab_users(spark, folder), "testgroup", metrics)
    return effects.pair(summary, "testgroup", "a", "b")


def _premium_metrics() -> dict:
    return {
        "cr_payer": F.col("payer"),
        "cr_premium": F.col("premium_buyer"),
        "cr_trial": F.col("trial_buyer"),
        "arpu": F.col("total_revenue"),
        "premium_arpu": F.col("premium_revenue"),
        "arppu": F.when(F.col("payer"), F.col("total_revenue")),
        "premium_arppu": F.when(F.col("premium_buyer"), F.col("premium_revenue")),
    }


PREMIUM_SHARES = ["cr_payer", "cr_premium", "cr_trial"]


@query("welch")
def welch(spark, folder):
    pairs = _ab_pairs(spark, folder).where(F.col("metric") != "conversion")
    columns = ["metric", "n_c", "n_t", "mean_c", "mean_t", "diff", "se", "t", "dof", "p_value", "ci_low", "ci_high"]
    return tidy(effects.welch_test(pairs).select(*columns), 4, p_value=6, t=6)


@query("prop_ztest")
def prop_ztest(spark, folder):
    pairs = _ab_pairs(spark, folder).where(F.col("metric") == "conversion")
    return tidy(effects.proportion_test(pairs).select("metric", "n_c", "n_t", "mean_c", "mean_t", "diff", "z", "p_value"))


@query("prop_ci")
def prop_ci(spark, folder):
    pairs = _ab_pairs(spark, folder).where(F.col("metric") == "conversion")
    return tidy(effects.proportion_intervals(pairs).select(
        "metric", "diff", "wald_low", "wald_high", "newcombe_low", "newcombe_high"
    ))


@query("chi2_conv")
def chi2_conv(spark, folder):
    users = inputs.ab_users(spark, folder).withColumn("is_payer", F.col("revenue") > 0)
    cells = contingency.cell_counts(users, "testgroup", ["a", "b"], ["is_payer"])
    both = contingency.chi2_test(cells, 2, correction=False).withColumn("corrected", F.lit(False)).unionByName(
        contingency.chi2_test(cells, 2).withColumn("corrected", F.lit(True))
    )
    return tidy(both)


@query("chi2_balance")
def chi2_balance(spark, folder):
    cells = contingency.cell_counts(
        inputs.experiment_users(spark, folder), "group", inputs.ARMS, ["country", "gender"]
    )
    return tidy(contingency.chi2_test(cells, 3))


FEATURES = ("age", "attraction_coeff", "views_count")


def _feature_ranks(people: DataFrame) -> DataFrame:
    return rank_tests.rank_sums(
        rank_tests.unpivot_metrics(people, ["group"], FEATURES), "group", inputs.ARMS
    )


def kept_people(spark, folder) -> DataFrame:
    """Experiment users, computed once for jobs that read them more than once."""
    return materialised(inputs.experiment_users(spark, folder))


@query("kruskal")
def kruskal(spark, folder):
    return tidy(rank_tests.kruskal_test(_feature_ranks(kept_people(spark, folder)), 3), 6, ties=0, rank_sum_0=1, rank_sum_1=1, rank_sum_2=1)


def _ctr_ranks(spark, folder) -> DataFrame:
    users = kept_feed_users(spark, folder)
    return rank_tests.rank_sums(rank_tests.unpivot_metrics(users, ["exp_group"], ["ctr", "views"]), "exp_group", [1, 2])


@query("mann_whitney")
def mann_whitney(spark, folder):
    return tidy(rank_tests.mann_whitney_test(_ctr_ranks(spark, folder)), 6, ties=0, rank_sum_0=1, rank_sum_1=1, u=1)


@query("mann_whitney_exact")
def mann_whitney_exact(spark, folder):
    """Revenue of two arms inside country and segment, exact at these sample sizes."""
    people = inputs.experiment_users(spark, folder).select("country", "gender", "group", F.col("total_revenue").alias("value"))
    return tidy(rank_tests.mann_whitney_exact(people, "group", ["control_1", "test"], ["country", "gender"]))


@query("balance")
def balance(spark, folder):
    people = kept_people(spark, folder)
    cells = contingency.cell_counts(people, "group", inputs.ARMS, ["country", "gender"])
    categories = contingency.chi2_test(cells, 3).select("feature", "p_value")
    numbers = rank_tests.kruskal_test(_feature_ranks(people), 3).select(
        F.col("metric").alias("feature"), "p_value"
    )
    both = categories.unionByName(numbers)
    return tidy(both.withColumn("significant_difference", F.col("p_value") < 0.05))


@query("aa_check")
def aa_check(spark, folder):
    summary = effects.summarise(user_experiment(spark, folder), "group", _premium_metrics())
    pairs = effects.pair(summary, "group", "control_1", "control_2")
    table = effects.effect_table(pairs, PREMIUM_SHARES)
    kept = table.where(F.col("metric").isin("cr_payer", "cr_premium", "arpu", "premium_arpu"))
    return tidy(kept.select("metric", "p_value", F.col("significant").alias("significant_difference")))


@query("effect_table")
def effect_table(spark, folder):
    users = experiment.pooled(user_experiment(spark, folder))
    summary = effects.summarise(users, "comparison", _premium_metrics())
    table = effects.effect_table(effects.pair(summary, "comparison", "control", "test"), PREMIUM_SHARES)
    return tidy(table, 4, p_value=6, ci_low=2, ci_high=2)


@query("poisson_boot")
def poisson_boot(spark, folder):
    return tidy(bootstrap.poisson_bootstrap(
        feed_users(spark, folder), "exp_group", 1, 2, "likes", "views", "user_id", REPLICATES, method="md5"
    ), 8)


@query("poisson_boot_replicates")
def poisson_boot_replicates(spark, folder):
    return tidy(bootstrap.replicate_ratios(
        feed_users(spark, folder), "exp_group", "likes", "views", "user_id", REPLICATES, method="md5"
    ), 8)


@query("poisson_boot_mean")
def poisson_boot_mean(spark, folder):
    """Bootstrap of mean revenue: the ratio with a denominator of one."""
    users = inputs.ab_users(spark, folder).withColumn("one", F.lit(1))
    return tidy(bootstrap.poisson_bootstrap(
        users, "testgroup", "a", "b", "revenue", "one", "user_id", REPLICATES, method="md5"
    ), 4, p_value=8)


@query("test_summary")
def test_summary(spark, folder):
    """p of the six tests of the click-through experiment."""
    users = ctr.smoothed_ctr(kept_feed_users(spark, folder))
    buckets = ctr.bucket_ctr(users, BUCKETS, method="md5")
    by_user = effects.welch_test(effects.pair(effects.summarise(
        users, "exp_group", {"Welch user CTR": F.col("ctr"), "Welch smoothed CTR": F.col("smoothed_ctr")}
    ), "exp_group", 1, 2))
    by_bucket = effects.welch_test(effects.pair(effects.summarise(
        buckets, "exp_group", {"Welch bucket CTR": F.col("bucket_ctr")}
    ), "exp_group", 1, 2))

    def ranked(df, column, name, slices=None):
        long = df.select("exp_group", F.lit(name).alias("metric"), F.col(column).alias("value"))
        sums = rank_tests.rank_sums(long, "exp_group", [1, 2], slices=slices)
        return rank_tests.mann_whitney_test(sums)

    boot = bootstrap.poisson_bootstrap(
        users, "exp_group", 1, 2, "likes", "views", "user_id", REPLICATES, method="md5"
    ).withColumn("metric", F.lit("Poisson bootstrap"))
    parts = [
        by_user, by_bucket, ranked(users, "ctr", "Mann-Whitney user CTR"),
        ranked(buckets, "bucket_ctr", "Mann-Whitney bucket CTR", slices=1), boot,
    ]
    out = None
    for part in parts:
        part = part.select(F.col("metric").alias("method"), "p_value")
        out = part if out is None else out.unionByName(part)
    return tidy(out.withColumn("significant", F.col("p_value") < 0.05))


MODEL_METRICS = ("dau", "ctr", "views", "new_posts", "unique_viewed_posts")


def _mart_series(spark, folder) -> DataFrame:
    mart = marts.daily_mart(inputs.feed(spark, folder), MART_END)
    return intervention.long_series(mart, "date", MODEL_METRICS)


@query("intervention")
def intervention_headline(spark, folder):
    """The level model is the headline; the earlier mean is kept beside it."""
    forecast = intervention.level_forecast(_mart_series(spark, folder), PRE, POST)
    return tidy(intervention.level_effect(forecast), 4)


@query("intervention_mean")
def intervention_mean(spark, folder):
    return tidy(intervention.mean_effect(_mart_series(spark, folder), PRE, POST), 4)


def _type_series(spark, folder) -> DataFrame:
    """Events and value per day and event type."""
    daily = inputs.events(spark, folder).groupBy("event_type", F.to_date("ts").alias("date")).agg(
        F.count("*").alias("events"), F.sum("value").alias("value_sum")
    )
    return intervention.long_series(daily, "date", ["events", "value_sum"], ["event_type"])


@query("intervention_segments")
def intervention_segments(spark, folder):
    return tidy(intervention.mean_effect(_type_series(spark, folder), PRE, POST, ["event_type", "metric"]), 4)


@query("intervention_level")
def intervention_level(spark, folder):
    keys = ["event_type", "metric"]
    forecast = intervention.level_forecast(_type_series(spark, folder), PRE, POST, keys)
    return tidy(intervention.level_effect(forecast, keys), 4)


@query("intervention_daily")
def intervention_daily(spark, folder):
    forecast = intervention.level_forecast(_type_series(spark, folder), PRE, POST, ["event_type", "metric"])
    return tidy(forecast.select("event_type", "metric", "date", "actual", "predicted", "low", "high"), 4)


@query("intervention_structural")
def intervention_structural(spark, folder):
    """Level, fading slope and weekly season; posterior draws, so there is no SQL."""
    forecast = structural.structural_forecast(_mart_series(spark, folder), PRE, POST)
    return tidy(structural.structural_effect(forecast), 4)


@query("intervention_components")
def intervention_components(spark, folder):
    return tidy(structural.structural_components(_mart_series(spark, folder), (PRE[0], POST[1])), 4)


# ---- chart data ----------------------------------------------------------------------------


@query("hist_density")
def hist_density(spark, folder):
    return tidy(charts.histogram(kept_feed_users(spark, folder), "exp_group", "ctr", 50))


@query("ecdf")
def ecdf(spark, folder):
    return tidy(charts.ecdf(kept_feed_users(spark, folder), "exp_group", "ctr"))


@query("box_stats")
def box_stats(spark, folder):
    """Revenue per paying user."""
    payers = inputs.ab_users(spark, folder).where(F.col("revenue") > 0)
    return tidy(charts.box_numbers(payers, "testgroup", "revenue"), 4)


# ---- event engagement ----------------------------------------------------------------------


@query("event_reach")
def event_reach(spark, folder):
    return tidy(engagement.event_reach(inputs.activity(spark, folder), "view", "click"))


@query("retention_event")
def retention_event(spark, folder):
    """Retention after the first participation, here the first click."""
    activity = inputs.activity(spark, folder)
    long = retention.calculate_retention(
        engagement.first_participation(activity, "click"), inputs.authorizations(spark, folder), max_days=14
    )
    return tidy(retention.weighted_retention(long, [1, 7, 14]))


@query("funnel")
def funnel(spark, folder):
    return tidy(engagement.funnel(inputs.activity(spark, folder), FUNNEL))


@query("time_to_step")
def time_to_step(spark, folder):
    return tidy(engagement.time_to_step(inputs.activity(spark, folder), "view", "click", "purchase"), 2)


@query("sessions")
def sessions(spark, folder):
    return tidy(engagement.user_sessions(inputs.activity(spark, folder), 180))


@query("session_lengths")
def session_lengths(spark, folder):
    return tidy(engagement.session_lengths(inputs.activity(spark, folder), 180), 2)


@query("participants_by_age")
def participants_by_age(spark, folder):
    return tidy(engagement.participants_by_age(inputs.activity(spark, folder), "click"))


@query("session_summary")
def session_summary(spark, folder):
    return tidy(engagement.session_summary(inputs.activity(spark, folder), 180))


@query("churn_after")
def churn_after(spark, folder):
    return tidy(engagement.churn_after(inputs.activity(spark, folder), "view", "2024-01-10", "2024-01-16"))


@query("stickiness")
def stickiness(spark, folder):
    return tidy(engagement.stickiness(inputs.activity(spark, folder), 7))


@query("rollback")
def rollback(spark, folder):
    return tidy(engagement.rollback_metrics(inputs.activity(spark, folder), "level"), 4)


@query("retry_chains")
def retry_chains(spark, folder):
    return tidy(progress.retry_chains(inputs.activity(spark, folder), "level", 95))


@query("spend_after_rollback")
def spend_after_rollback(spark, folder):
    spend = inputs.spending(spark, folder)
    return tidy(progress.spend_after_rollback(inputs.activity(spark, folder), "level", spend), 4)


@query("daily_mart_incremental")
def daily_mart_incremental(spark, folder):
    """The mart built in three updates, the second one twice; the same rows as ``daily_mart``."""
    feed = inputs.feed(spark, folder)
    place = f"{shared_folder(spark)}/mart-{uuid.uuid4().hex}"
    for start, end in (("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-01-31")):
        incremental.update_daily_mart(feed, f"{place}/mart", f"{place}/state", start, end)
    return tidy(spark.read.parquet(f"{place}/mart"))


@query("dq_date_order")
def dq_date_order(spark, folder):
    return tidy(quality.date_order_report(inputs.dated_files(spark, folder), "file", "paid_at", "payment_id"))


def _lives(spark, folder) -> DataFrame:
    """Lives of users in two arms; a user silent for two days has left."""
    events = inputs.activity(spark, folder).withColumn("arm", F.when(F.pmod("user_id", F.lit(2)) == 0, "a").otherwise("b"))
    return lifetime.lifetimes(events, ["arm"], "2024-01-27", 2)


@query("survival")
def survival(spark, folder):
    return tidy(lifetime.survival(_lives(spark, folder), ["arm"]))


@query("log_rank")
def log_rank(spark, folder):
    return tidy(lifetime.log_rank(_lives(spark, folder), "arm", "a", "b"))


@query("lifetime_value")
def lifetime_value(spark, folder):
    return tidy(lifetime.lifetime_value(_lives(spark, folder), inputs.spending(spark, folder), [0, 7, 14, 25], ["arm"]), 4)


@query("stratified_assignment")
def stratified_assignment(spark, folder):
    """Customers dealt 2 : 1 to two arms inside country and segment."""
    users = inputs.experiment_users(spark, folder).select("uid", "country", "gender")
    return assignment.stratified_assignment(users, ["country", "gender"], {"control": 2, "test": 1}, "uid", "7")


@query("tail_check")
def tail_check(spark, folder):
    users = inputs.experiment_users(spark, folder)
    return tidy(tails.tail_check(users, "group", "total_revenue"))


@query("tail_effect")
def tail_effect(spark, folder):
    checks = tails.tail_check(inputs.experiment_users(spark, folder), "group", "total_revenue")
    return tidy(tails.tail_effect(checks, "group", "control_1", "test"))


@query("funnel_by")
def funnel_by(spark, folder):
    """Funnels of two arms with a signup as the reward."""
    events = inputs.activity(spark, folder).withColumn("arm", F.when(F.pmod("user_id", F.lit(2)) == 0, "a").otherwise("b"))
    return tidy(engagement.funnel(events, FUNNEL, by=["arm"], reward="signup"))


def _period_users(spark, folder) -> DataFrame:
    """Revenue per user before and after the start of the later period."""
    post = F.col("ts") >= F.lit(POST[0]).cast("timestamp_ntz")
    return inputs.events(spark, folder).groupBy("user_id", post.alias("post")).agg(
        F.sum("value").alias("value"), F.count("*").alias("events")
    ).withColumn("testgroup", F.when(F.pmod("user_id", F.lit(2)) == 0, "a").otherwise("b"))


@query("diff_in_diff")
def diff_in_diff(spark, folder):
    metrics = {"value": F.col("value"), "events": F.col("events")}
    table = effects.difference_in_differences(_period_users(spark, folder), "testgroup", "a", "b", "post", metrics)
    return tidy(table, 4, p_value=6)


@query("mde")
def mde(spark, folder):
    pairs = _ab_pairs(spark, folder)
    return tidy(effects.detectable_effect(pairs).select("metric", "n_c", "n_t", "mde", "mde_pct", "n_per_arm_5pct"), 4)


@query("stratified")
def stratified(spark, folder):
    """Revenue effect within countries, averaged over them."""
    users = experiment.pooled(user_experiment(spark, folder))
    metrics = {"arpu": F.col("total_revenue"), "cr_payer": F.col("payer")}
    summary = effects.summarise(users, "comparison", metrics, ["country"])
    pairs = effects.pair(summary, "comparison", "control", "test", ["country"])
    return tidy(effects.stratified_effect(pairs, "country"), 4, p_value=6)
