from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortwise.sources import readers, schemas, sinks


def test_delimited_with_fixed_schema(spark, tmp_path):
    path = tmp_path / "reg.csv"
    path.write_text("reg_ts;uid\n1704067200;1\n1704067201;2\n")
    df = readers.read_delimited(spark, str(path), schemas.REGISTRATIONS)
    assert df.schema == schemas.REGISTRATIONS and df.count() == 2
    assert readers.table_or_path(spark, str(path), schemas.REGISTRATIONS).collect() == df.collect()


def test_malformed_or_renamed_input_fails(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("reg_ts;uid\nsoon;1\n")
    with pytest.raises(Exception):
        readers.read_delimited(spark, str(bad), schemas.REGISTRATIONS).collect()
    other = tmp_path / "other.csv"
    other.write_text("when;who\n1;1\n")
    with pytest.raises(Exception):
        readers.read_delimited(spark, str(other), schemas.REGISTRATIONS).collect()
    assert readers.read_by_position(spark, str(other), schemas.REGISTRATIONS, ";").first() == (1, 1)


def test_missing_column_is_named(spark):
    with pytest.raises(ValueError, match="auth_ts"):
        readers.table_or_path(spark, spark.range(1).withColumnRenamed("id", "uid"), schemas.AUTHORIZATIONS)


def test_tagged_files(spark, tmp_path):
    for tag in ("control_1", "test"):
        (tmp_path / f"{tag}.csv").write_text("student_id;rev\n1;2.5\n")
    df = readers.read_tagged(
        spark, {t: str(tmp_path / f"{t}.csv") for t in ("control_1", "test")}, schemas.CHECKS
    )
    assert sorted((r.group, r.rev) for r in df.collect()) == [("control_1", 2.5), ("test", 2.5)]


def test_parsed_lines(spark):
    line = spark.createDataFrame([("7;1.5",)], "line string")
    assert line.select(readers.parse_delimited(F.col("line"), schemas.CHECKS).alias("r")).first().r == (7, 1.5)


def test_store_options():
    whole = readers.jdbc_options("jdbc:x", "SELECT 1", user="me")
    assert whole == {"url": "jdbc:x", "query": "SELECT 1", "user": "me"}
    parts = readers.jdbc_options("jdbc:x", "SELECT a FROM t", ("a", 0, 100, 8))
    assert parts["dbtable"] == "(SELECT a FROM t) AS source"
    assert (parts["partitionColumn"], parts["lowerBound"], parts["upperBound"], parts["numPartitions"]) == ("a", "0", "100", "8")


def test_daily_mart_sink_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "mart")
    first = spark.createDataFrame([(date(2024, 1, 1), 5), (date(2024, 1, 2), 6)], "date date, dau long")
    sinks.write_daily_mart(first, path)
    sinks.write_daily_mart(spark.createDataFrame([(date(2024, 1, 2), 9)], "date date, dau long"), path)
    got = {(r.date, r.dau) for r in spark.read.parquet(path).collect()}
    assert got == {(date(2024, 1, 1), 5), (date(2024, 1, 2), 9)}
    sinks.write_daily_csv(first, str(tmp_path / "csv"))
    back = readers.read_delimited(spark, str(tmp_path / "csv"), schemas.table_schema(date="date", dau="long"), ",")
    assert back.count() == 2


def test_sql_store_asks_for_a_partition(spark):
    with pytest.raises(ValueError, match="partition"):
        readers.read_sql_store(spark, "jdbc:none", "select 1")
