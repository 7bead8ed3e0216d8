"""The few statements a database itself must run, per product."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from typing import Any

from rowtide.errors import ConfigError
from rowtide.functions.text import literal_text
from rowtide.sources.connections import Connection


def quote(dialect: str, name: str) -> str:
    mark = "`" if dialect == "mysql" else '"'
    return mark + name.replace(mark, mark * 2) + mark


def table_name(conn: Connection, table: str) -> str:
    """A table for Spark's writer, whose Oracle sessions know nothing of a current schema."""
    name = quote(conn.type, table)
    return f"{quote(conn.type, conn.schema)}.{name}" if conn.type == "oracle" and conn.schema else name


def literal(dialect: str, value: Any) -> str:
    """A value inside a statement.

    MySQL also reads backslashes in text; Oracle takes a bare text for a date only in the
    session's own format, so it gets typed ones; bytes differ everywhere.
    """
    if dialect == "mysql" and isinstance(value, str):
        value = value.replace("\\", "\\\\")
    if dialect == "oracle" and isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.replace(tzinfo=None).isoformat(' ', 'microseconds')}'"
    if dialect == "oracle" and isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (bytes, bytearray)):
        text = bytes(value).hex()
        if dialect == "postgresql":
            return f"'\\x{text}'::bytea"
        if dialect == "oracle":
            return f"HEXTORAW('{text}')"
    return literal_text(value)


def select_sql(dialect: str, table: str, columns: Sequence[str] = (), where: str | None = None) -> str:
    """A table read with its own projection and condition."""
    cols = ", ".join(quote(dialect, c) for c in columns) or "*"
    sql = f"SELECT {cols} FROM {quote(dialect, table)}"
    return f"{sql} WHERE {where}" if where else sql


def subquery(dialect: str, sql: str, alias: str = "rt_q") -> str:
    """``sql`` as something to select from; Oracle knows no AS for it."""
    return f"({sql.strip().rstrip(';').strip()}) {alias}"


def page_sql(dialect: str, sql: str, order: Sequence[str], offset: int, limit: int) -> str:
    """One page of ``sql``, in the product's own syntax.  Without an order pages overlap."""
    by = ", ".join(quote(dialect, c) for c in order)
    body = f"SELECT * FROM {subquery(dialect, sql)} ORDER BY {by}"
    if dialect == "oracle":
        return f"{body} OFFSET {offset} ROWS FETCH NEXT {limit} ROWS ONLY"
    return f"{body} LIMIT {limit} OFFSET {offset}"


def staging_sql(dialect: str, stage: str, target: str, columns: Sequence[str], row_id: str) -> str:
    """An empty table with the target's column types, and a row number column."""
    cols = ", ".join(quote(dialect, c) for c in columns)
    number = f"CAST(0 AS {'SIGNED' if dialect == 'mysql' else 'NUMBER(19)' if dialect == 'oracle' else 'BIGINT'})"
    body = f"SELECT {cols}, {number} AS {quote(dialect, row_id)} FROM {quote(dialect, target)}"
    return f"CREATE TABLE {quote(dialect, stage)} AS {body} WHERE 1 = 0"


def staged_sql(dialect: str, stage: str, columns: Sequence[str], row_id: str) -> str:
    """The staged rows, one per row number: a task that was repeated may have sent some twice."""
    cols, rid = ", ".join(quote(dialect, c) for c in columns), quote(dialect, row_id)
    numbered = (
        f"SELECT {cols}, row_number() OVER (PARTITION BY {rid} ORDER BY {rid}) AS rt_n FROM {quote(dialect, stage)}"
    )
    return f"SELECT {cols} FROM ({numbered}) rt_s WHERE rt_n = 1"


def insert_sql(dialect: str, target: str, stage: str, columns: Sequence[str], row_id: str) -> str:
    cols = ", ".join(quote(dialect, c) for c in columns)
    return f"INSERT INTO {quote(dialect, target)} ({cols}) {staged_sql(dialect, stage, columns, row_id)}"


def upsert_sql(
    dialect: str, target: str, stage: str, columns: Sequence[str], keys: Sequence[str], row_id: str
) -> str:
    """One statement that merges the staged rows into the target by ``keys``."""
    insert = insert_sql(dialect, target, stage, columns, row_id)
    values = [quote(dialect, c) for c in columns if c not in keys]
    key_names = [quote(dialect, k) for k in keys]
    if dialect == "postgresql":
        sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in values)
        return f"{insert} ON CONFLICT ({', '.join(key_names)}) " + (f"DO UPDATE SET {sets}" if sets else "DO NOTHING")
    same = " AND ".join(f"t.{k} = s.{k}" for k in key_names)
    rows, tgt = staged_sql(dialect, stage, columns, row_id), quote(dialect, target)
    names = [quote(dialect, c) for c in columns]
    cols = ", ".join(names)
    if dialect == "mysql":
        if values:
            return f"{insert} ON DUPLICATE KEY UPDATE " + ", ".join(f"{c} = VALUES({c})" for c in values)
        missing = f"NOT EXISTS (SELECT 1 FROM {tgt} t WHERE {same})"
        return f"INSERT INTO {tgt} ({cols}) SELECT {cols} FROM ({rows}) s WHERE {missing}"
    update = ", ".join(f"t.{c} = s.{c}" for c in values)
    matched = f" WHEN MATCHED THEN UPDATE SET {update}" if update else ""
    sent = ", ".join(f"s.{c}" for c in names)
    return (
        f"MERGE INTO {tgt} t USING ({rows}) s ON ({same}){matched} "
        f"WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({sent})"
    )


def count_sql(dialect: str, stage: str, row_id: str) -> str:
    """Staged rows, each counted once."""
    return f"SELECT count(*) FROM (SELECT DISTINCT {quote(dialect, row_id)} FROM {quote(dialect, stage)}) rt_s"


def delete_sql(dialect: str, table: str) -> str:
    return f"DELETE FROM {quote(dialect, table)}"


def empty_sql(dialect: str, target: str) -> str:
    """Empty a table inside a transaction: TRUNCATE commits at once on MySQL and Oracle."""
    if dialect == "postgresql":
        return f"TRUNCATE TABLE {quote(dialect, target)}"
    return delete_sql(dialect, target)


#: What SQL text is made of, as far as quotes and comments go.
_SPANS = re.compile(r"'(?:[^'\\]|\\.|'')*'?|\"[^\"]*\"?|`[^`]*`?|--[^\n]*|/\*.*?(?:\*/|\Z)", re.DOTALL)
_SPANS_PLAIN = re.compile(r"'(?:[^']|'')*'?|\"[^\"]*\"?|`[^`]*`?|--[^\n]*|/\*.*?(?:\*/|\Z)", re.DOTALL)
_NAMED = re.compile(r"(?<!:):([A-Za-z_]\w*)|\?")


def spans(sql: str, backslashes: bool = False) -> list[tuple[int, int, str]]:
    """Start, end and kind of each quoted text, quoted name and comment; kind is its first character.

    ``backslashes``: whether one hides a quote, as in Spark and MySQL.
    """
    return [(m.start(), m.end(), m[0][0]) for m in (_SPANS if backslashes else _SPANS_PLAIN).finditer(sql)]


def bound(dialect: str, sql: str, args: Mapping[str, Any] | Sequence[Any] | None) -> str:
    """``sql`` with its ``:names`` or ``?`` as typed literals; quoted text and comments stay."""
    if not args:
        return sql
    named, places = isinstance(args, Mapping), iter(() if isinstance(args, Mapping) else args)
    used = []

    def one(m: re.Match[str]) -> str:
        if m[1] is None:
            if named:
                return m[0]
            try:
                used.append(next(places))
            except StopIteration:
                raise ConfigError("the select has more places than parameters") from None
            return literal(dialect, used[-1])
        if not named:
            return m[0]
        if m[1] not in args:
            raise ConfigError(f"no value for parameter {m[1]!r}")
        return literal(dialect, args[m[1]])

    out, at = [], 0
    for start, end, _ in [*spans(sql, dialect == "mysql"), (len(sql), len(sql), "")]:
        out += [_NAMED.sub(one, sql[at:start]), sql[start:end]]
        at = end
    if not named and len(used) != len(args):
        raise ConfigError(f"the select has {len(used)} places for {len(args)} parameters")
    return "".join(out)


def depth_sql(dialect: str, sql: str, column: str, count: int) -> str:
    """Where ``count`` slices of equal depth begin, by a column of any type; the database ranks its rows."""
    c, number, begin = (quote(dialect, x) for x in (column, "rt_slice", "rt_begin"))
    ranked = f"SELECT {c}, ntile({count}) OVER (ORDER BY {c}) AS {number} FROM {subquery(dialect, sql)} WHERE {c} IS NOT NULL"
    return f"SELECT {begin} FROM {subquery(dialect, f'SELECT {number}, min({c}) AS {begin} FROM {subquery(dialect, ranked)} GROUP BY {number}', 'rt_b')} ORDER BY {begin}"


def slice_conditions(dialect: str, column: str, begins: Sequence[Any]) -> list[str]:
    """One condition for each slice: disjoint, and together every row; nulls go with the first."""
    c = quote(dialect, column)
    at = [literal(dialect, b) for b in dict.fromkeys(begins)][1:]
    if not at:
        return ["1 = 1"]
    middle = [f"{c} >= {low} AND {c} < {high}" for low, high in zip(at, at[1:], strict=False)]
    return [f"({c} < {at[0]} OR {c} IS NULL)", *middle, f"{c} >= {at[-1]}"]


RUNS = "rt_runs"


def runs_table_sql(dialect: str) -> str:
    """The table of appends that took effect; it lives beside the targets."""
    text, number = ("VARCHAR2(255)", "NUMBER(19)") if dialect == "oracle" else ("VARCHAR(255)", "BIGINT")
    t, r, n = (quote(dialect, x) for x in ("target_name", "run_id", "rows_written"))
    return f"CREATE TABLE {quote(dialect, RUNS)} ({t} {text} NOT NULL, {r} {text} NOT NULL, {n} {number} NOT NULL, PRIMARY KEY ({t}, {r}))"


def run_sql(dialect: str, target: str, run_id: str) -> str:
    """Rows of an append that took effect; nothing if it did not, as -1."""
    t, r, n = (quote(dialect, x) for x in ("target_name", "run_id", "rows_written"))
    return f"SELECT coalesce(max({n}), -1) FROM {quote(dialect, RUNS)} WHERE {t} = {literal(dialect, target)} AND {r} = {literal(dialect, run_id)}"


def run_done_sql(dialect: str, target: str, run_id: str, rows: int) -> str:
    """The run's row, in the transaction that appends: a second one breaks its key."""
    return f"INSERT INTO {quote(dialect, RUNS)} VALUES ({literal(dialect, target)}, {literal(dialect, run_id)}, {rows})"
