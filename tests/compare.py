"""Compare a Spark result with its DuckDB twin, column by column."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels",
          "benchmark")


def connect(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = f"{data_dir}/{table}.parquet"
        if os.path.exists(path):
            files = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty if both sides agree in columns, types and values."""
    found = []
    relation = con.sql(sql)
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types]))
    if sorted(spark_df.columns) != sorted(kinds):
        return [f"columns: {sorted(spark_df.columns)} != {sorted(kinds)}"]
    names = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
             "DATE": "date", "TIMESTAMP": "timestamp_ntz"}
    for name, kind in spark_df.dtypes:
        if names.get(kinds[name], kinds[name]) != kind:
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    ours = ordered(spark_df.columns, spark_df.collect())
    theirs = ordered(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} != {len(theirs)}")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0][0]} != {wrong[0][1]}")
    return found
