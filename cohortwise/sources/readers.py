"""Readers: delimited files, tagged file sets, remote SQL stores."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortwise.functions.columns import require_columns


def read_delimited(
    spark: SparkSession, path, schema: StructType, sep: str = ";", header: bool = True
) -> DataFrame:
    """Delimited text with a fixed schema; a malformed row or a drifted header fails the job."""
    return spark.read.csv(
        path, schema=schema, sep=sep, header=header, mode="FAILFAST", enforceSchema=False
    )


def read_by_position(
    spark: SparkSession, path, schema: StructType, sep: str = ","
) -> DataFrame:
    """Delimited text whose header names may differ: columns are taken by position."""
    return spark.read.csv(
        path, schema=schema, sep=sep, header=True, mode="FAILFAST", enforceSchema=True
    )


def parse_delimited(line: Column, schema: StructType, sep: str = ";") -> Column:
    """Struct parsed from one delimited line held in a column."""
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return F.from_csv(line, ddl, {"sep": sep, "mode": "FAILFAST"})


def table_or_path(
    spark: SparkSession, data, schema: StructType, sep: str = ";"
) -> DataFrame:
    """Accept a DataFrame or a path to a delimited file, keep only the schema's columns."""
    df = data if isinstance(data, DataFrame) else read_delimited(spark, str(data), schema, sep)
    require_columns(df, schema.fieldNames(), "input")
    return df.select(*schema.fieldNames())


def tag_union(frames: Mapping[str, DataFrame], column: str = "group") -> DataFrame:
    """Stack same-schema tables (UNION ALL by name), each with its own tag."""
    tagged = [df.withColumn(column, F.lit(tag)) for tag, df in frames.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def read_tagged(
    spark: SparkSession, paths: Mapping[str, str], schema: StructType,
    sep: str = ";", column: str = "group",
) -> DataFrame:
    """Several files of one schema as one table with a tag per file."""
    return tag_union(
        {tag: read_delimited(spark, path, schema, sep) for tag, path in paths.items()}, column
    )


def jdbc_options(
    url: str, query: str, partition: tuple[str, object, object, int] | None = None, **extra
) -> dict[str, str]:
    """Options of a partitioned JDBC scan.

    ``partition`` is (column, lower, upper, parts): with it the store is read by ``parts``
    tasks at once, each with its own range of the column. Without it one task reads all.
    """
    options = {"url": url, **{k: str(v) for k, v in extra.items()}}
    if partition is None:
        return {**options, "query": query}
    column, lower, upper, parts = partition
    return {
        **options,
        "dbtable": f"({query}) AS source",
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def read_sql_store(
    spark: SparkSession, url: str, query: str,
    partition: tuple[str, object, object, int] | None = None, single_task: bool = False, **extra,
) -> DataFrame:
    """Rows of a query on a remote SQL store (ClickHouse, Postgres) over JDBC.

    Without a partition the whole result passes one task, so that has to be asked for.
    """
    if partition is None and not single_task:
        raise ValueError("give a partition, or single_task=True for a small result")
    return spark.read.format("jdbc").options(
        **jdbc_options(url, query, partition, **extra)
    ).load()
