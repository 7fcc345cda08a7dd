"""Compare a Spark result with the result of its SQL in DuckDB."""

from __future__ import annotations

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return f"{value:.12g}"
    return str(value)


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_bag(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), bag([tuple(row) for row in df.collect()], df.columns)


def duck_bag(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return sorted(columns), bag(result.fetchall(), columns)
