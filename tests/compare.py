"""Run a registered query in Spark and its SQL in DuckDB and compare whole results."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        if os.path.isdir(path):
            path += "/*.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return 0.0 if number == 0 else number
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def normalised(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=repr)


def differences(spark_df, con, sql, limit=5):
    """Empty list when the results agree."""
    left = normalised(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    right = normalised([d[0] for d in cursor.description], cursor.fetchall())
    if left[0] != right[0]:
        return [f"columns {left[0]} != {right[0]}"]
    if len(left[1]) != len(right[1]):
        return [f"rows {len(left[1])} != {len(right[1])}"]
    return [f"{a} != {b}" for a, b in zip(left[1], right[1]) if a != b][:limit]
