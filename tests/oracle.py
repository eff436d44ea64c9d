"""Holds a Spark result against DuckDB's over the same parquet files."""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime | date):
        return str(v)
    if isinstance(v, list | tuple):
        return tuple(_plain(x) for x in v)
    return v


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def by_duckdb(sql: str, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf_dir}/{name}')")
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    return columns, got.fetchall()


def differences(df, sql: str, sf_dir: str) -> str:
    """Empty if both give the same bag of rows under the same column names."""
    columns, rows = by_duckdb(sql, sf_dir)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    ours, theirs = bag(df.columns, df.collect()), bag(columns, rows)
    if ours != theirs:
        return f"{sum(ours.values())} and {sum(theirs.values())} rows; only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}"
    return ""
