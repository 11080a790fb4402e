import pytest
from pyspark.sql import functions as F

from cohortwise.operators import bootstrap, ctr, marts
from cohortwise.functions.columns import age_band, hash_bucket, poisson_weight


@pytest.fixture
def feed(spark):
    return spark.sql("""select cast(t as timestamp_ntz) as time, u as user_id, p as post_id, a as action, g as exp_group from values
        ('2024-01-01 23:59:59', 1L, 'p1', 'view', 1), ('2024-01-02 00:00:00', 1L, 'p1', 'view', 1),
        ('2024-01-02 10:00:00', 1L, 'p2', 'like', 1), ('2024-01-02 11:00:00', 2L, 'p2', 'like', 2),
        ('2024-01-03 12:00:00', 2L, 'p1', 'view', 2), ('2024-01-03 23:59:59.5', 3L, 'p3', 'view', 3)
        as t(t, u, p, a, g)""")


def test_user_ctr_range_and_zero_views(feed, rows):
    got = rows(ctr.user_ctr(feed, "2024-01-02", "2024-01-02", [1, 2]), "user_id")
    assert [(r["user_id"], r["likes"], r["views"], r["ctr"]) for r in got] == [(1, 1, 1, 1.0), (2, 1, 0, None)]
    assert ctr.user_ctr(feed, "2024-01-03", "2024-01-03").count() == 2


def test_smoothing_uses_one_pooled_rate(feed):
    got = ctr.smoothed_ctr(ctr.user_ctr(feed), alpha=5).collect()
    assert {round(r.pooled_ctr, 9) for r in got} == {0.5}
    assert {r.user_id: r.smoothed_ctr for r in got}[3] == pytest.approx(2.5 / 6)


def test_bucket_quantile(spark):
    users = spark.range(1, 11).selectExpr("id as user_id", "1 as exp_group", "id as likes", "10L as views", "id / 10.0D as ctr")
    row = ctr.bucket_ctr(users, 1).first()
    assert (row.users, row.bucket_ctr, row.ctr9) == (10, 0.55, 1.0)


def test_buckets_do_not_depend_on_the_group_or_partitioning(spark):
    df = spark.range(1000)
    for method in ("md5", "xxhash64"):
        a = {r.id: r.b for r in df.select("id", hash_bucket(F.col("id"), 50, method).alias("b")).collect()}
        b = {r.id: r.b for r in df.repartition(13).select("id", hash_bucket(F.col("id"), 50, method).alias("b")).collect()}
        assert a == b and set(a.values()) == set(range(50))
    with pytest.raises(ValueError):
        hash_bucket(F.col("id"), 5, "crc")


def test_daily_mart(feed, rows):
    got = rows(marts.daily_mart(feed, "2024-01-03 23:00:00"), "date")
    assert [tuple(r.values())[1:] for r in got] == [
        (1, 0, 1, 0.0, 1, 1), (2, 2, 1, 2.0, 1, 1), (1, 0, 1, 0.0, 1, 0),
    ]
    fresh = rows(marts.new_entities(feed, "post_id", "time"), "date")
    assert [(str(r["date"]), r["new_posts"]) for r in fresh] == [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 1)]


def test_age_bands(spark):
    df = spark.createDataFrame([(a,) for a in (17, 18, 24, 25, 34, 35, 44, 45, 54, 55, None)], "age int")
    got = [r[0] for r in df.select(age_band(F.col("age"))).collect()]
    assert got == ["до 18", "18–24", "18–24", "25–34", "25–34", "35–44", "35–44", "45–54", "45–54", "55+", None]


def test_service_overlap(spark):
    df = spark.sql("""select timestamp_ntz'2024-01-01 00:00:00' as time, * from values
        (1L, 'feed'), (1L, 'messenger'), (2L, 'feed'), (3L, 'messenger'), (4L, null) as t(user_id, service)""")
    assert marts.service_overlap(df).first().asDict() == {"base_users": 2, "both_users": 1, "overlap": 0.5}
    assert {(r.service, r.dau) for r in marts.dau_by_service(df).collect()} == {("feed", 2), ("messenger", 2)}


def test_weights_are_poisson_and_stable(spark):
    for method in ("md5", "xxhash64"):
        w = poisson_weight(F.col("id"), F.lit(3), 42, method).alias("w")
        stats = spark.range(40000).select(w).agg(F.avg("w"), F.variance("w")).first()
        assert stats[0] == pytest.approx(1.0, abs=0.03) and stats[1] == pytest.approx(1.0, abs=0.06)


def test_bootstrap_ignores_partitioning_and_centres_on_the_ratio(spark):
    users = spark.range(600).selectExpr(
        "id as user_id", "cast(id % 2 as int) as g", "pmod(hash(id), 7) as likes", "cast(10 + pmod(hash(id, 1), 9) as long) as views"
    )
    first = bootstrap.poisson_bootstrap(users, "g", 0, 1, "likes", "views", "user_id", 300).first()
    second = bootstrap.poisson_bootstrap(users.repartition(11), "g", 0, 1, "likes", "views", "user_id", 300).first()
    assert first == second and first.replicates == 300
    r = {x.g: x.l / x.v for x in users.groupBy("g").agg(F.sum("likes").alias("l"), F.sum("views").alias("v")).collect()}
    assert first.mean_difference == pytest.approx(r[1] - r[0], abs=0.01)
    assert first.ci_low < first.mean_difference < first.ci_high and 0 < first.p_value <= 1


def test_digest_words_give_the_same_weights_in_blocks(spark):
    users = spark.range(40).selectExpr("id as user_id", "1 as g", "id as a", "1L as b")
    got = bootstrap.replicate_ratios(users, "g", "a", "b", "user_id", 10, 42, "md5").collect()
    crossed = users.withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(9))))
    want = crossed.withColumn("w", poisson_weight(F.col("user_id"), F.col("r"), 42, "md5")).groupBy("r").agg(
        F.sum(F.col("w") * F.col("a")).alias("n"), F.sum(F.col("w")).alias("d")
    ).collect()
    assert {(x.replicate, x.weighted_numerator, x.weighted_denominator) for x in got} == {(x.r, x.n, x.d) for x in want}
