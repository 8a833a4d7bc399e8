"""Comparison of a Spark result with the plain-SQL result over the same tables."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return repr(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between ``df`` and the SQL result: columns, number of rows, values."""
    found = []
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns: {sorted(df.columns)} expected {sorted(names)}"]
    actual, expected = rows_of(df.columns, df.collect()), rows_of(names, expected_rows)
    if len(actual) != len(expected):
        found.append(f"rows: {len(actual)} expected {len(expected)}")
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    if different:
        found.append(f"{len(different)} rows differ, first: {different[0]}")
    return found
