"""Run a query and its SQL and compare them as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime):
        return value.date()
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_bag(df) -> Counter:
    return bag(df.columns, (tuple(r) for r in df.collect()))


def sql_bag(con, sql: str) -> Counter:
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return bag(columns, cursor.fetchall())
