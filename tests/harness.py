"""Run a registered query in Spark and its SQL in DuckDB and compare all rows."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def sort_key(row):
    return [(v is None, type(v).__name__ if not isinstance(v, (int, float)) else "n", v if v is not None else 0) for v in row]


def rows_of(columns: list[str], rows) -> list[list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=sort_key)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows_of(names, expected.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows, expected {len(want)}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} of {len(want)} rows differ, first {wrong[0]}" if wrong else None
