"""Scans: tables, selects, pages and schemas, whatever the connection behind them."""

from __future__ import annotations

import re
import threading
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.operators import ranges
from rowtide.operators.lookup import restrict
from rowtide.sources import dialects, jdbc
from rowtide.sources.connections import Connection
from rowtide.sources.storage import Storage

# A page that ends beyond this row is located by counting, not by sorting everything.
DEEP_PAGE = 20_000
# Jobs of one session run side by side; each sees its own tables only.
_VIEWS = threading.Lock()


def scan(
    df: DataFrame,
    columns: Sequence[str] = (),
    where: str | Column | None = None,
    args: Mapping[str, Any] | None = None,
) -> DataFrame:
    """``SELECT columns FROM df WHERE where``, with named parameters for SQL text."""
    if where is not None:
        df = restrict(df, where, args)
    return df.select(*[V.col(c) for c in columns]) if columns else df


def select(
    spark: SparkSession,
    sql: str,
    args: Mapping[str, Any] | Sequence[Any] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Any SELECT, with named or positional parameters.

    ``tables`` are visible to it as views, and to nothing else: names are resolved here
    and now, and views of the session that have the same name come back afterwards.
    """
    body = sql.strip().rstrip(";").strip()
    if not body:
        raise ConfigError("the select is empty")
    bound = None if args is None else dict(args) if isinstance(args, Mapping) else list(args)
    if not tables:
        return spark.sql(body, args=bound)
    with _VIEWS:
        hidden = {name: spark.table(name) for name in tables if _is_view(spark, name)}
        try:
            for name, df in tables.items():
                df.createOrReplaceTempView(name)
            return spark.sql(body, args=bound)
        finally:
            for name in tables:
                if name in hidden:
                    hidden[name].createOrReplaceTempView(name)
                else:
                    spark.catalog.dropTempView(name)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary


def page(df: DataFrame, order: Sequence[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset .. offset + limit`` in the order of the given columns.

    Ties are broken by the remaining columns, so that pages do not overlap.  Early pages
    are a top-k.  For deep ones rows are counted by ranges at sampled cuts, whatever the types; only the
    ranges that hold the page's ends are looked into.
    """
    if offset < 0 or limit < 0 or not order:
        raise ConfigError("a page needs an order, an offset and a limit")
    full = [*order, *[c for c in df.columns if c not in order]]
    by = [V.col(c) for c in full]
    if offset + limit <= DEEP_PAGE:
        return df.orderBy(*by).offset(offset).limit(limit)
    return ranges.window(df, full, offset, limit).orderBy(*by)


def schema_rows(schema: T.StructType, keys: Sequence[str] = ()) -> list[jdbc.ColumnInfo]:
    """Name, type text, nullability, key membership and 1-based position of every column."""
    return [
        jdbc.ColumnInfo(
            f.name,
            f.metadata.get("native_type", f.dataType.simpleString()),
            f.nullable,
            f.name in keys,
            i,
        )
        for i, f in enumerate(schema.fields, start=1)
    ]


def schema_frame(spark: SparkSession, columns: Sequence[jdbc.ColumnInfo]) -> DataFrame:
    """The same as a frame: one row per column."""
    fields = "name string, data_type string, nullable boolean, is_primary boolean, ordinal int"
    rows = [(c.name, c.data_type, c.nullable, c.is_primary, c.ordinal) for c in columns]
    return spark.createDataFrame(rows, fields)


class Tables:
    """Tables of named connections.

    A ``files`` connection holds one folder or file per table; a folder written by the
    upsert sink is read at its committed version.
    """

    def __init__(self, spark: SparkSession, connections: Mapping[str, Connection]):
        self.spark, self.connections = spark, dict(connections)

    def connection(self, name: str) -> Connection:
        if name not in self.connections:
            raise ConfigError(f"unknown connection {name!r}; known: {sorted(self.connections)}")
        return self.connections[name]

    def path(self, conn: Connection, table: str) -> str:
        return f"{conn.path}/{conn.pattern.format(table=table)}"

    def read(
        self,
        connection: str,
        table: str,
        columns: Sequence[str] = (),
        where: str | None = None,
        slices: jdbc.Slices | None = None,
        fetch: int = jdbc.FETCH_ROWS,
        key: str | None = None,
        keys: DataFrame | None = None,
    ) -> DataFrame:
        """A table of a connection; for databases ``where`` is in their own SQL.

        With ``keys`` (one column) a database is only asked for rows that can match.
        """
        conn = self.connection(connection)
        if conn.is_database and key is not None and keys is not None:
            return jdbc.read_for_keys(self.spark, conn, table, columns, key, keys, fetch)
        if conn.is_database:
            return jdbc.read_table(self.spark, conn, table, columns, where, slices, fetch)
        return scan(self._files(conn, table), columns, where)

    def _files(self, conn: Connection, table: str) -> DataFrame:
        from rowtide.sinks.paths import is_target, read_target

        if conn.type == "catalog":
            return self.spark.table(conn.table_name(table))
        path = self.path(conn, table)
        if is_target(self.spark, path):
            return read_target(self.spark, path)
        return self.spark.read.format(conn.format).options(**conn.params).load(path)

    def schema(self, connection: str, table: str) -> list[jdbc.ColumnInfo]:
        conn = self.connection(connection)
        if conn.is_database:
            return jdbc.table_columns(self.spark, conn, table)
        return schema_rows(self._files(conn, table).schema)

    def select(self, connection: str, sql: str, args: Mapping[str, Any] | None = None) -> DataFrame:
        """A select: a database runs it itself; over files, its tables are the folder's."""
        conn = self.connection(connection)
        if conn.is_database:
            return jdbc.read_sql(self.spark, conn, dialects.bound(conn.type, sql, args))
        if conn.type == "catalog":
            return select(self.spark, sql, args or None)
        views = {t: self._files(conn, t) for t in self._tables_of(conn, sql)}
        return select(self.spark, sql, args or None, views)

    def page(self, connection: str, sql: str, order: Sequence[str], offset: int, limit: int) -> DataFrame:
        """One page of a select, in the given order."""
        conn = self.connection(connection)
        if conn.is_database:
            return jdbc.read_sql(self.spark, conn, dialects.page_sql(conn.type, sql, order, offset, limit))
        return page(self.select(connection, sql), order, offset, limit)

    def _tables_of(self, conn: Connection, sql: str) -> list[str]:
        """Tables of the folder whose name occurs in the text."""
        head, _, tail = conn.pattern.partition("{table}")
        names = []
        for entry in Storage(self.spark).list(conn.path):
            if entry.startswith(head) and entry.endswith(tail) and len(entry) > len(head) + len(tail):
                names.append(entry[len(head) : len(entry) - len(tail)])
        return [n for n in names if re.search(rf"(?i)\b{re.escape(n)}\b", sql)]
