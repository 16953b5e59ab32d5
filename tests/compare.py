"""Running a query and its SQL side by side."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())


def difference(left, right) -> str | None:
    """None when equal to the last bit."""
    if left[0] != right[0]:
        return f"columns {left[0]} / {right[0]}"
    if len(left[1]) != len(right[1]):
        return f"{len(left[1])} / {len(right[1])} rows"
    for a, b in zip(left[1], right[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} / {b}"
    return None
