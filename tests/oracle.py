"""Run registered queries against their SQL and compare columns, rows and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from feedloom.plans.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", repr(value + 0.0))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, (list, tuple)):
        return ("l", tuple(plain(v) for v in value))
    if isinstance(value, dt.datetime):
        return ("t", value.isoformat())
    return None if value is None else (type(value).__name__, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, name, query, sql, sf_dir):
    """None if equal, else a text that says what differs."""
    frame = query(spark, sf_dir)
    left = table(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    right = table([c[0] for c in result.description], result.fetchall())
    if left[0] != right[0]:
        return f"{name}: columns {left[0]} != {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{name}: {len(left[1])} rows != {len(right[1])}"
    wrong = [(a, b) for a, b in zip(left[1], right[1]) if a != b]
    return f"{name}: {len(wrong)} of {len(left[1])} rows differ, first {left[0]} {wrong[0]}" if wrong else None
