"""Compare a Spark result with DuckDB's result of the reference SQL, value by value."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else float(f"{value:.12g}")
    if isinstance(value, int):
        return float(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """None when equal, else a short account of what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = rows_of(names, cur.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns: only Spark {sorted(set(df.columns) - set(names))}, only SQL {sorted(set(names) - set(df.columns))}"
    got = rows_of(df.columns, df.collect())
    if got == expected:
        return None
    more, less = got - expected, expected - got
    first_more = sorted(more, key=repr)[:2]
    first_less = sorted(less, key=repr)[:2]
    return (
        f"rows {sum(got.values())} vs {sum(expected.values())}; columns {sorted(names)}\n"
        f"  only Spark ({sum(more.values())}): {first_more}\n  only SQL ({sum(less.values())}): {first_less}"
    )
