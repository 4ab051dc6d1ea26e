"""Compare query results with their SQL counterparts, value by value."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of_duck(con, sql: str):
    cur = con.execute(sql)
    return _bag([d[0] for d in cur.description], cur.fetchall())


def rows_of_spark(df):
    return _bag(df.columns, [tuple(r) for r in df.collect()])


def _bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v
