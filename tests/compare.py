"""Runs queries on Spark and their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    """One form for the same value of either engine; floats to 12 significant digits."""
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def bag(columns, rows) -> tuple[list[str], Counter]:
    names = sorted(columns)
    places = [list(columns).index(n) for n in names]
    return names, Counter(tuple(plain(row[i]) for i in places) for row in rows)


def spark_rows(df):
    return bag(df.columns, [tuple(r) for r in df.collect()])


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def duck_rows(con, sql: str):
    found = con.execute(sql)
    return bag([d[0] for d in found.description], found.fetchall())


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def type_differences(df, con, sql: str) -> dict:
    """Columns whose types are not the same in both engines."""
    spark_types = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    sql_types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    names = spark_types.keys() | sql_types.keys()
    pairs = {n: (spark_types.get(n), sql_types.get(n)) for n in names}
    return {n: pair for n, pair in pairs.items() if pair[0] != pair[1]}


def differences(left, right, limit: int = 3) -> str:
    """Empty when equal."""
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    if not only_left and not only_right:
        return ""
    return (
        f"rows {sum(left[1].values())} / {sum(right[1].values())}; "
        f"only spark {list(only_left.items())[:limit]}; only sql {list(only_right.items())[:limit]}"
    )
