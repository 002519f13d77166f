"""Compare a Spark result with its SQL oracle: names, row count, multiset of values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        return ("dec", v.normalize() if v else decimal.Decimal(0))
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("float", float(f"{v:.10g}"))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def mismatch(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else a short description."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = rows_of(expected_columns, result.fetchall())
    got = rows_of(df.columns, df.collect())
    if sorted(expected_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    if got == expected:
        return None
    extra, lacking = got - expected, expected - got
    return (
        f"rows {sum(got.values())} vs {sum(expected.values())}; "
        f"only spark {len(extra)}: {list(extra)[:3]}; only sql {len(lacking)}: {list(lacking)[:3]}"
    )
