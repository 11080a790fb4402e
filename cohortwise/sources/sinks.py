"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_daily_mart(mart: DataFrame, path: str, day: str = "date") -> None:
    """Write a daily table, one directory per day, replacing only the days present.

    Repartitioning by the day keeps one file per day instead of one per task and day;
    the mart has one row per day, so nothing here grows with the raw events.
    """
    (
        mart.repartition(day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def write_daily_csv(mart: DataFrame, path: str, day: str = "date") -> None:
    """Write a daily table as delimited text with a header, sorted by day."""
    mart.coalesce(1).sortWithinPartitions(day).write.mode("overwrite").csv(path, header=True)
