"""Compare a Spark result with DuckDB's on the same files: names, rows and values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in order) for r in data]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)) if isinstance(v, Decimal) else "", str(v)) for v in r))


def compare(df, sql: str, sf: str) -> str | None:
    """None when equal, otherwise what differs."""
    con = connect(sf)
    rel = con.sql(sql)
    names, got_names = sorted(rel.columns), sorted(df.columns)
    if names != got_names:
        return f"columns {got_names} != {names}"
    want, got = rows(rel.columns, rel.fetchall()), rows(df.columns, [tuple(r) for r in df.collect()])
    if len(want) != len(got):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want, strict=True):
        if g != w or [type(a) for a in g] != [type(b) for b in w]:
            return f"row {g} != {w}"
    return None
