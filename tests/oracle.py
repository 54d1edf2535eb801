"""Compare a Spark result with a DuckDB query over the same parquet tables.

Mirrors the driver's check: same row count, same column names (compared
sorted), and the same multiset of rows.
"""

from __future__ import annotations

import datetime as dt
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of_spark(df: DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.collect()]
    return cols, rows


def rows_of_duck(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_norm(r[i]) for i in order) for r in rel.fetchall()]
    return [names[i] for i in order], rows


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[bool, str]:
    scols, srows = rows_of_spark(df)
    dcols, drows = rows_of_duck(con, sql)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return False, f"row counts differ: spark={len(srows)} duck={len(drows)}"
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    s_sorted, d_sorted = sorted(srows, key=key), sorted(drows, key=key)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first differing row: spark={a} duck={b}"
    return True, f"{len(srows)} rows equal"
