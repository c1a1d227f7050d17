"""Compares a Spark result with DuckDB's for the same query: names, types, row count and values."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def kind(value) -> str:
    return "none" if value is None else type(value).__name__


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((kind(v), str(v)) for v in r))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else the first difference."""
    rows = [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(rows) != len(theirs):
        return f"{len(rows)} rows != {len(theirs)}"
    a, b = normal(df.columns, rows), normal(names, theirs)
    for x, y in zip(a, b):
        if x != y or [kind(v) for v in x] != [kind(v) for v in y]:
            return f"{sorted(names)}: {x} != {y}"
    return None
