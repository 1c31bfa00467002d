"""Spark-vs-DuckDB comparison used by the tests (order-insensitive)."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def rows_of(cols: list[str], records) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark_df, sql: str, sf_dir: str, con=None) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    rel = con.sql(sql)
    d_cols = [c for c in rel.columns]
    d_rows = rel.fetchall()
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    if sorted(c.lower() for c in d_cols) != sorted(c.lower() for c in s_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}"
    if len(d_rows) != len(s_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a = rows_of([c.lower() for c in s_cols], s_rows)
    b = rows_of([c.lower() for c in d_cols], d_rows)
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff spark={x} duck={y}"
    return True, f"{len(s_rows)} rows equal"
