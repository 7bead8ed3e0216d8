"""Conditions against a plain statement of their rules, over every pair of value classes."""

from __future__ import annotations

import datetime as dt
import itertools
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.predicates import EPSILON, condition
from rowtide.functions.text import python_moment_text

COLUMNS = {
    "i": ("bigint", [None, 0, 3, -3, 7]),
    "j": ("int", [3, None, 3, 4, -7]),
    "x": ("double", [3.0, 2.5, None, -0.0, 1e20]),
    "d": ("decimal(10,2)", [Decimal("3.00"), None, Decimal("-1.50"), Decimal("2.50"), Decimal("10.00")]),
    "s": ("string", ["", "3", None, "abc", "2024-01-01"]),
    "r": ("string", ["abc", None, "b", "", "é"]),
    "b": ("boolean", [True, False, None, True, False]),
    "t": ("timestamp_ntz", [dt.datetime(2024, 1, 1), None, dt.datetime(2024, 1, 1, 5), dt.datetime(2023, 5, 5, 1, 1, 1, 7), dt.datetime(2025, 1, 1)]),
    "u": ("date", [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None, dt.date(2020, 2, 29), dt.date(2025, 1, 1)]),
    "y": ("binary", [b"", b"a", None, b"\xff", b"a"]),
}
LITERALS = {
    "null": None, "true": True, "FALSE": False, "3": 3, "-1.5": -1.5, "1e20": 1e20, "abc": "abc", "''": "", "'3'": "3",
    "2024-01-01": "2024-01-01", "0": 0, ".5": 0.5, "é": "é", "+3": 3,
}
OPS = ("eq", "ne", "gt", "gte", "lt", "lte")


def number(v):
    return None if v is None or isinstance(v, bool) or not isinstance(v, (int, float, Decimal)) else float(v)


def text(v):
    """Text, decimals and dates have a text; everything else counts as empty."""
    if isinstance(v, str):
        return v
    if isinstance(v, Decimal):
        return f"{v:.2f}"
    if isinstance(v, dt.datetime):
        return python_moment_text(v)
    return v.isoformat() if isinstance(v, dt.date) else ""


def kind(v):
    return "date" if isinstance(v, dt.date) else type(v).__name__


def equal(a, b):
    if a is None or b is None:
        return False
    if number(a) is not None and number(b) is not None:
        return abs(number(a) - number(b)) < EPSILON
    if "date" in (kind(a), kind(b)) and {kind(a), kind(b)} <= {"date", "str"}:
        return text(a) == text(b)
    return kind(a) == kind(b) and a == b


def holds(op, a, b):
    if op in ("eq", "ne"):
        return equal(a, b) == (op == "eq")
    if number(a) is not None and number(b) is not None:
        a, b = number(a), number(b)
    else:
        a, b = text(a).encode(), text(b).encode()
    return {"gt": a > b, "gte": a >= b, "lt": a < b, "lte": a <= b}[op]


def test_every_pair(spark):
    schema = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, (t, _) in COLUMNS.items()])
    # Every value of a column meets every value of another.
    data = []
    names = list(COLUMNS)
    for shift in range(5):
        for k in range(5):
            data.append(tuple(COLUMNS[n][1][(k + shift * i) % 5] for i, n in enumerate(names)))
    df = spark.createDataFrame(data, schema).coalesce(1)
    tokens = {**LITERALS, **{f"${n}": n for n in names}, "$nope": None}
    exprs = [f"{c} {op} {tok}" for c, op, tok in itertools.product([*names, "nope"], OPS, tokens)]
    rows = [dict(zip(names, r, strict=True)) for r in data]
    for start in range(0, len(exprs), 220):
        chunk = exprs[start : start + 220]
        got = df.select(*[F.coalesce(condition(e, df), F.lit(False)).alias(str(i)) for i, e in enumerate(chunk)]).collect()
        for row, answers in zip(rows, got, strict=True):
            for e, answer in zip(chunk, answers, strict=True):
                c, op, tok = e.split()
                right = row.get(tok[1:]) if tok.startswith("$") else LITERALS[tok]
                assert answer == holds(op, row.get(c), right), (e, row)
