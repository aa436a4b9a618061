"""Compare a registered query with its SQL, as multisets of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{root}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(value) + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if hasattr(value, "normalize"):
        return float(value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(con, sql: str, df) -> str | None:
    """None when equal, else a short description of the difference."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(names)} and {sorted(df.columns)}"
    want = rows_of(names, expected.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return None
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"only here {list((got - want).items())[:3]}; only in SQL {list((want - got).items())[:3]}"
    )
