"""Order-insensitive comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

from cliploom.plans.registry import TABLES


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("%.9g" % (value + 0.0))
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def bag(rows, order) -> Counter:
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    ours = [tuple(row) for row in df.collect()]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a = bag(ours, [df.columns.index(c) for c in sorted(names)])
    b = bag(theirs, [names.index(c) for c in sorted(names)])
    if a == b:
        return None if ours else "no rows"
    return f"rows {len(ours)} vs {len(theirs)}; only here {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
