"""Compare a Spark result with a SQL result: same columns, same bag of values."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (decimal.Decimal, datetime.date)):
        raise TypeError(f"not a portable value: {value!r}")
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(frame, connection, sql: str) -> tuple[int, list[str]]:
    """(row count, differences)."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    rows = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return 0, [f"columns {sorted(frame.columns)} against {sorted(names)}"]
    ours = bag(frame.columns, frame.collect())
    theirs = bag(names, rows)
    extra, lacking = ours - theirs, theirs - ours
    problems = [f"only ours: {r}" for r in list(extra)[:3]] + [f"only theirs: {r}" for r in list(lacking)[:3]]
    return sum(ours.values()), problems
