"""Tables and selects of a database, read by parallel tasks."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.sources import dialects
from rowtide.sources.connections import Connection

FETCH_ROWS = 10_000
# Keys that are sent to a database as lists, and how many go into one.
LISTED_KEYS = 20_000
KEYS_PER_LIST = 500


@dataclass(frozen=True)
class Slices:
    """How a read is cut: by ranges of a column.

    Equal widths between two bounds suit numbers and dates that are evenly spread; equal
    ``depth`` suits any type and spread, and costs the database a ranking of the column.
    """

    column: str
    count: int
    low: Any = None
    high: Any = None
    depth: bool = False


def _reader(spark: SparkSession, conn: Connection, fetch: int):
    return spark.read.format("jdbc").options(**conn.jdbc_options()).option("fetchsize", fetch)


def read_sql(
    spark: SparkSession,
    conn: Connection,
    sql: str,
    slices: Slices | None = None,
    fetch: int = FETCH_ROWS,
) -> DataFrame:
    """The rows of a select that the database runs.

    Without ``slices`` one task reads everything; with them every task reads a range.
    Bounds that are not given are asked for first (one row).  They only place the cuts:
    rows outside them, and nulls, are read too.
    """
    source = dialects.subquery(conn.type, sql)
    if slices is None:
        return _reader(spark, conn, fetch).option("numPartitions", 1).option("dbtable", source).load()
    if slices.depth:
        begins = _reader(spark, conn, fetch).option("numPartitions", 1).option("query", dialects.depth_sql(conn.type, sql, slices.column, slices.count)).load()
        # At most as many rows as slices.
        cuts = [r[0] for r in begins.collect()]
        return _read_parts(spark, conn, source, dialects.slice_conditions(conn.type, slices.column, cuts), fetch)
    low, high = slices.low, slices.high
    if low is None or high is None:
        c = dialects.quote(conn.type, slices.column)
        ends = f"SELECT min({c}) AS {dialects.quote(conn.type, 'lo')}, max({c}) AS {dialects.quote(conn.type, 'hi')} FROM {source}"
        row = _reader(spark, conn, 1).option("numPartitions", 1).option("query", ends).load().first()
        if row is None or row[0] is None:
            return read_sql(spark, conn, sql, None, fetch)
        low, high = (low if low is not None else row[0]), (high if high is not None else row[1])
    return (
        _reader(spark, conn, fetch)
        .option("dbtable", source)
        .option("partitionColumn", slices.column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", max(1, slices.count))
        .load()
    )


def read_table(
    spark: SparkSession,
    conn: Connection,
    table: str,
    columns: Sequence[str] = (),
    where: str | None = None,
    slices: Slices | None = None,
    fetch: int = FETCH_ROWS,
) -> DataFrame:
    """A table read; ``where`` is in the database's own SQL."""
    return read_sql(spark, conn, dialects.select_sql(conn.type, table, columns, where), slices, fetch)


def read_for_keys(
    spark: SparkSession,
    conn: Connection,
    table: str,
    columns: Sequence[str],
    key: str,
    keys: DataFrame,
    fetch: int = FETCH_ROWS,
) -> DataFrame:
    """At least the rows of ``table`` whose ``key`` is among ``keys`` (one column).

    A moderate number of keys goes to the database as lists, one per task; for more, the
    range of the keys is read in slices.
    """
    found = keys.where(V.col(keys.columns[0]).isNotNull()).distinct()
    few = [r[0] for r in found.limit(LISTED_KEYS + 1).collect()]
    column = dialects.quote(conn.type, key)
    if not few:
        return read_table(spark, conn, table, columns, "1 = 0", fetch=fetch)
    if len(few) <= LISTED_KEYS:
        lists = [few[i : i + KEYS_PER_LIST] for i in range(0, len(few), KEYS_PER_LIST)]
        conditions = [
            f"{column} IN ({', '.join(dialects.literal(conn.type, v) for v in part)})" for part in lists
        ]
        source = dialects.subquery(conn.type, dialects.select_sql(conn.type, table, columns))
        return _read_parts(spark, conn, source, conditions, fetch)
    dtype = keys.schema.fields[0].dataType
    if not can_slice(dtype):
        return read_table(spark, conn, table, columns, None, key_slices(spark, conn, table, columns), fetch)
    low, high = found.agg(F.min(found[0]).cast("string"), F.max(found[0]).cast("string")).first()
    text = "'{}'" if V.value_class(dtype) == V.DATE else "{}"
    where = f"{column} BETWEEN {text.format(low)} AND {text.format(high)}"
    return read_table(spark, conn, table, columns, where, Slices(key, conn.max_pool_size, low, high), fetch)


def _read_parts(
    spark: SparkSession, conn: Connection, source: str, conditions: Sequence[str], fetch: int
) -> DataFrame:
    options = conn.jdbc_options()
    url = options.pop("url")
    options.pop("numPartitions")
    properties = {**options, "fetchsize": str(fetch)}
    parts = spark.read.jdbc(url, source, predicates=list(conditions), properties=properties)
    # One list per query, but no more queries at a time than the connection allows.
    return parts.coalesce(conn.max_pool_size)


def can_slice(dtype: T.DataType | None) -> bool:
    if dtype is None or isinstance(dtype, (T.FloatType, T.DoubleType)):
        return False
    return V.value_class(dtype) in (V.NUMBER, V.DATE)


@contextlib.contextmanager
def session(spark: SparkSession, conn: Connection) -> Iterator[Any]:
    """A database connection of the driver, for single statements.  No rows pass here."""
    options = conn.jdbc_options()
    jvm = spark._jvm
    if options.get("driver"):
        registry = jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry
        registry.register(options["driver"])
    properties = jvm.java.util.Properties()
    for key, value in options.items():
        if key not in ("url", "driver", "numPartitions", "sessionInitStatement"):
            properties.setProperty(key, value)
    handle = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        if options.get("sessionInitStatement"):
            execute(handle, options["sessionInitStatement"])
        yield handle
    finally:
        handle.close()


def execute(handle: Any, sql: str) -> int:
    """Run one statement; the number of rows it touched."""
    statement = handle.createStatement()
    try:
        return max(0, int(statement.executeUpdate(sql)))
    finally:
        statement.close()


def scalar(handle: Any, sql: str) -> int:
    """The one number a query returns."""
    statement = handle.createStatement()
    try:
        rows = statement.executeQuery(sql)
        rows.next()
        return int(rows.getLong(1))
    finally:
        statement.close()


def _exactly(meta: Any, name: str | None) -> str | None:
    """A name for the catalogue, which takes patterns: its wildcards are escaped."""
    escape = meta.getSearchStringEscape()
    if name is None or not escape:
        return name
    for c in (escape, "_", "%"):
        name = name.replace(c, escape + c)
    return name


def has_table(handle: Any, schema: str | None, table: str) -> bool:
    """Whether the current database has this table, by its exact name."""
    meta = handle.getMetaData()
    rows = meta.getTables(handle.getCatalog(), _exactly(meta, schema or handle.getSchema()), _exactly(meta, table), None)
    try:
        while rows.next():
            if rows.getString("TABLE_NAME") == table:
                return True
        return False
    finally:
        rows.close()


def transaction(handle: Any, statements: Sequence[str]) -> list[int]:
    """Run statements as one unit."""
    before = handle.getAutoCommit()
    handle.setAutoCommit(False)
    try:
        counts = [execute(handle, sql) for sql in statements]
        handle.commit()
        return counts
    except Exception:
        handle.rollback()
        raise
    finally:
        handle.setAutoCommit(before)


@dataclass(frozen=True)
class ColumnInfo:
    """One column as the database's catalogue describes it."""

    name: str
    data_type: str
    nullable: bool
    is_primary: bool
    ordinal: int


def table_columns(spark: SparkSession, conn: Connection, table: str) -> list[ColumnInfo]:
    """The catalogue entry of a table; an unknown table is an error."""
    with session(spark, conn) as handle:
        meta = handle.getMetaData()
        keys, catalog, schema = set(), handle.getCatalog(), conn.schema or handle.getSchema()
        rows = meta.getPrimaryKeys(catalog, schema, table)
        while rows.next():
            keys.add(rows.getString("COLUMN_NAME"))
        rows.close()
        out = []
        rows = meta.getColumns(catalog, _exactly(meta, schema), _exactly(meta, table), None)
        while rows.next():
            if rows.getString("TABLE_NAME") != table:
                continue
            name, size = rows.getString("COLUMN_NAME"), rows.getInt("COLUMN_SIZE")
            native = rows.getString("TYPE_NAME").lower()
            if "char" in native:
                native = f"{native}({size})"
            elif native in ("decimal", "numeric", "number"):
                native = f"{native}({size},{rows.getInt('DECIMAL_DIGITS')})"
            out.append(
                ColumnInfo(
                    name,
                    native,
                    rows.getString("IS_NULLABLE") != "NO",
                    name in keys,
                    int(rows.getInt("ORDINAL_POSITION")),
                )
            )
        rows.close()
    if not out:
        raise ConfigError(f"connection {conn.name!r} has no table {table!r}")
    return sorted(out, key=lambda c: c.ordinal)


def key_slices(
    spark: SparkSession, conn: Connection, table: str, columns: Sequence[str] = ()
) -> Slices | None:
    """Slices along the first key column that has an order to cut, if it is among ``columns``."""
    keys = [c.name for c in table_columns(spark, conn, table) if c.is_primary]
    if not keys:
        return None
    schema = read_table(spark, conn, table, keys).schema
    for f in schema.fields:
        if can_slice(f.dataType) and (not columns or f.name in columns):
            return Slices(f.name, conn.max_pool_size)
    return None
