"""Every operator as a query over the given tables, with the SQL it must agree with."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.text import moment_text
from rowtide.operators import lookup as L
from rowtide.operators import mapping as M
from rowtide.operators import ranges
from rowtide.operators import routing as R
from rowtide.operators import split as S
from rowtide.operators import steps as E
from rowtide.operators import upsert as U
from rowtide.operators import watermark as W
from rowtide.operators.ranking import dedup_last, first_n
from rowtide.plans.job import Job
from rowtide.plans.runner import Runner
from rowtide.plans.templates import Template
from rowtide.sinks.paths import PathSink, read_target
from rowtide.sources import tables as X
from rowtide.sources.connections import Connection
from rowtide.sources.storage import fresh_dir
from rowtide.streaming import microbatch
from rowtide.types import Constant, lower_bound

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CLOCK = dt.datetime(2024, 1, 31)


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own or the given name, with its SQL."""

    def add(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        SQL[name or fn.__name__] = " ".join(sql.split())
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def given_tables(spark: SparkSession, sf: str, name: str = "tpch") -> X.Tables:
    """The given folder as a connection."""
    conn = Connection.parse(name, {"type": "files", "path": sf, "pattern": "{table}.parquet"})
    return X.Tables(spark, {name: conn})


# ---- scans -----------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def scan_columns(spark, sf):
    return X.scan(table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def scan_where(spark, sf):
    where = "o_orderstatus = :status AND o_totalprice > :price"
    return X.scan(
        table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"], where, {"status": "F", "price": 100000}
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def scan_partitioned(spark, sf):
    """Twelve slices of about equal depth, each by one range condition that reaches the scan."""
    lines = X.scan(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_quantity"])
    return reduce(DataFrame.unionAll, ranges.slices(lines, "l_orderkey", 12))


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000")
def page_window(spark, sf):
    orders = X.scan(table(spark, sf, "orders"), ["o_orderkey", "o_custkey"])
    return X.page(orders, ["o_orderkey"], 1000, 500)


@query("""
    SELECT k, l_orderkey, l_linenumber, l_partkey FROM (
        SELECT l_returnflag || '-' || l_linestatus AS k, l_orderkey, l_linenumber, l_partkey,
               row_number() OVER (ORDER BY l_returnflag || '-' || l_linestatus, l_orderkey, l_linenumber, l_partkey) - 1 AS n,
               count(*) OVER () AS total FROM lineitem) x
    WHERE n >= total - total // 4 AND n < total - total // 4 + 700
""")
def page_window_text(spark, sf):
    """A page in the order of a text column, behind three quarters of all rows: found by counts of ranges, not by a large top-k."""
    lines = table(spark, sf, "lineitem").select(F.concat_ws("-", "l_returnflag", "l_linestatus").alias("k"), "l_orderkey", "l_linenumber", "l_partkey")
    total = lines.count()
    return X.page(lines, ["k"], total - total // 4, 700)


@query("""
    SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def select_join(spark, sf):
    return given_tables(spark, sf).select("tpch", SQL["select_join"])


@query("""
    SELECT c_mktsegment, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers,
           max(o_totalprice) AS max_price
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment
""")
def select_agg(spark, sf):
    return given_tables(spark, sf).select("tpch", SQL["select_agg"])


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice >= 200000")
def select_params(spark, sf):
    sql = "SELECT o_orderkey FROM orders WHERE o_orderstatus = ? AND o_totalprice >= ?"
    return X.select(spark, sql, ["O", 200000], {"orders": table(spark, sf, "orders")})


def _with_counts(spark: SparkSession, df: DataFrame, columns) -> DataFrame:
    """Schema rows beside the number of values each column holds."""
    counts = df.agg(*[F.count(F.col(c.name)).alias(c.name) for c in columns])
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c.name).alias("name"), F.col(c.name).alias("n")) for c in columns])
    ).alias("p")
    per_column = counts.select(pairs).select(F.col("p.name").alias("__name"), F.col("p.n").alias("n_values"))
    schema = X.schema_frame(spark, columns)
    return schema.join(per_column, F.col("name") == F.col("__name")).select("name", "ordinal", "n_values")


@query("""
    SELECT 'o_orderkey' AS name, CAST(1 AS INTEGER) AS ordinal, count(o_orderkey) AS n_values FROM orders
    UNION ALL SELECT 'o_custkey', 2, count(o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 3, count(o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', 4, count(o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 5, count(o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', 6, count(o_orderpriority) FROM orders
""")
def table_schema(spark, sf):
    tables = given_tables(spark, sf)
    return _with_counts(spark, tables.read("tpch", "orders"), tables.schema("tpch", "orders"))


@query("""
    WITH q AS (SELECT c_mktsegment, count(*) AS n_orders FROM orders JOIN customer
               ON o_custkey = c_custkey GROUP BY c_mktsegment)
    SELECT 'c_mktsegment' AS name, CAST(1 AS INTEGER) AS ordinal, count(c_mktsegment) AS n_values FROM q
    UNION ALL SELECT 'n_orders', 2, count(n_orders) FROM q
""")
def select_schema(spark, sf):
    df = given_tables(spark, sf).select(
        "tpch",
        "SELECT c_mktsegment, count(*) AS n_orders FROM orders JOIN customer "
        "ON o_custkey = c_custkey GROUP BY c_mktsegment",
    )
    return _with_counts(spark, df, X.schema_rows(df.schema))


# ---- incremental predicates ------------------------------------------------


@query("""
    SELECT o_orderkey, o_custkey, o_orderdate FROM orders
    WHERE o_orderdate > TIMESTAMP '1998-06-01 00:00:00'
""")
def incr_state(spark, sf):
    orders = table(spark, sf, "orders")
    mark = Constant(dt.datetime(1998, 6, 1), orders.schema["o_orderdate"].dataType)
    bound = Template(lambda key: {"max_created": mark}[key], CLOCK).bind("o_orderdate > ${state.max_created}")
    return X.scan(orders, ["o_orderkey", "o_custkey", "o_orderdate"], bound.sql, bound.args)


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > TIMESTAMP '1970-01-01 00:00:00'")
def incr_first_run(spark, sf):
    orders = table(spark, sf, "orders")
    template = Template(lambda key: lower_bound(orders.schema["o_orderdate"].dataType), CLOCK)
    bound = template.bind("o_orderdate > ${state.max_created}")
    return X.scan(orders, ["o_orderkey", "o_orderdate"], bound.sql, bound.args)


@query("""
    SELECT event_id, ts, user_id FROM events
    WHERE ts > TIMESTAMP '2024-01-30 12:00:00' OR ts > TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 1 DAY
""")
def incr_lookback(spark, sf):
    events = table(spark, sf, "events")
    mark = Constant(dt.datetime(2024, 1, 30, 12), events.schema["ts"].dataType)
    bound = Template(lambda key: mark, CLOCK).bind(
        "ts > ${state.max_ts} OR ts > ${sys.now('%Y-%m-%d %H:%M:%S') -1D}"
    )
    return X.scan(events, ["event_id", "ts", "user_id"], bound.sql, bound.args)


# ---- projections -----------------------------------------------------------


@query("SELECT o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS amount FROM orders")
def map_positional(spark, sf):
    return M.map_columns(
        table(spark, sf, "orders"),
        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"],
        ["order_id", "user_id", "amount"],
    )


@query("SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS missing_col FROM orders")
def map_target_only(spark, sf):
    return M.map_columns(table(spark, sf, "orders"), target=["o_orderkey", "o_orderstatus", "missing_col"])


@query("SELECT o_orderkey, o_custkey FROM orders")
def map_source_only(spark, sf):
    return M.map_columns(table(spark, sf, "orders"), source=["o_orderkey", "o_custkey"])


@query("SELECT c_custkey, c_name AS name, c_acctbal AS c_nationkey, c_mktsegment AS c_name FROM customer")
def rename_chain(spark, sf):
    items = [("c_name", "name"), ("c_mktsegment", "c_name"), ("c_acctbal", "c_nationkey"), ("nope", "x")]
    return E.rename(table(spark, sf, "customer"), items)


@query("SELECT c_custkey, 'lake' AS origin, CAST(7 AS BIGINT) AS batch_no, 'X' AS c_mktsegment FROM customer")
def set_constants(spark, sf):
    customer = M.keep_columns(table(spark, sf, "customer"), ["c_custkey", "c_mktsegment"])
    return E.set_constants(customer, {"origin": "lake", "batch_no": {"t": "Int", "v": 7}, "c_mktsegment": "X"})


@query("""
    SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS price_int,
           CAST(trim(' ' || CAST(o_custkey AS VARCHAR) || ' ') AS BIGINT) AS cust_int FROM orders
""")
def cast_int(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price_int"),
        F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("cust_int"),
    )
    return E.cast_columns(orders, [("price_int", "int"), ("cust_int", "BIGINT"), ("nope", "int")])


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_f FROM part")
def cast_float(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("size_f"))
    return E.cast_columns(part, [("size_f", "float")])


@query("""
    SELECT l_orderkey, l_linenumber, l_linenumber - 1 <> 0 AS b_int, l_returnflag = 'A' AS b_text
    FROM lineitem
""")
def cast_bool(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_linenumber") - 1).alias("b_int"),
        F.when(F.col("l_returnflag") == "A", " Yes").otherwise("n").alias("b_text"),
    )
    return E.cast_columns(lines, [("b_int", "bool"), ("b_text", "boolean")])


@query("""
    SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_s,
           CASE WHEN p_size > 20 THEN 'true' ELSE 'false' END AS flag_s, '0x' || hex(p_brand) AS brand_hex
    FROM part
""")
def cast_string(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("size_s"),
        (F.col("p_size") > 20).alias("flag_s"),
        F.col("p_brand").cast("binary").alias("brand_hex"),
    )
    return E.cast_columns(part, [("size_s", "string"), ("flag_s", "varchar"), ("brand_hex", "text")])


@query("""
    SELECT c_custkey, regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '') AS balance_s FROM customer
""")
def cast_float_text(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("balance_s"))
    return E.cast_columns(customer, [("balance_s", "string")])


@query("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders")
def cast_decimal(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("amount"))
    return E.cast_columns(orders, [("amount", "decimal(18,2)")])


@query("SELECT o_orderkey, o_totalprice FROM orders")
def keep_columns(spark, sf):
    return M.keep_columns(table(spark, sf, "orders"), ["o_orderkey", "nope", "o_totalprice"])


# ---- filters ---------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 150000")
def filter_keep(spark, sf):
    orders = E.filter_rows(table(spark, sf, "orders"), keep="o_totalprice gte 150000")
    return orders.select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 150000 AND NOT (o_orderstatus = 'F')")
def filter_keep_drop(spark, sf):
    orders = E.filter_rows(
        table(spark, sf, "orders"), keep="o_totalprice gte 150000", drop="o_orderstatus eq 'F'"
    )
    return orders.select("o_orderkey", "o_totalprice")


@query("SELECT event_id, event_type FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf):
    return E.filter_rows(table(spark, sf, "events"), keep="event_type eq purchase").select(
        "event_id", "event_type"
    )


def _with_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """The given tables hold no nulls, so one value of a column is made one."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif(F.col("l_linenumber"), F.lit(4)).alias("k")
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_linenumber, 4) AS k FROM lineitem
    WHERE NOT coalesce(nullif(l_linenumber, 4) = 3, FALSE)
""")
def filter_ne_null(spark, sf):
    return E.filter_rows(_with_nulls(spark, sf), keep="k ne 3")


@query("SELECT p_partkey, p_size FROM part WHERE p_size > 25")
def filter_gt(spark, sf):
    return E.filter_rows(table(spark, sf, "part"), keep="p_size gt 25").select("p_partkey", "p_size")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def filter_lt(spark, sf):
    return E.filter_rows(table(spark, sf, "customer"), keep="c_acctbal lt 0").select("c_custkey", "c_acctbal")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_linenumber, 4) AS k FROM lineitem
    WHERE nullif(l_linenumber, 4) IS NULL OR l_linenumber >= 3
""")
def filter_gte_null(spark, sf):
    return E.filter_rows(_with_nulls(spark, sf), keep="k gte 3")


@query("SELECT p_partkey, p_size FROM part WHERE p_size <= 10")
def filter_lte(spark, sf):
    return E.filter_rows(table(spark, sf, "part"), keep="p_size lte 10").select("p_partkey", "p_size")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE nullif(l_linenumber, 4) IS NULL")
def filter_is_null(spark, sf):
    return E.filter_rows(_with_nulls(spark, sf), keep="k is null").drop("k")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE nullif(l_linenumber, 4) IS NOT NULL")
def filter_not_null(spark, sf):
    return E.filter_rows(_with_nulls(spark, sf), keep="k not null").drop("k")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01 00:00:00'")
def filter_date(spark, sf):
    orders = E.filter_rows(table(spark, sf, "orders"), keep="o_orderdate gte 1998-06-01")
    return orders.select("o_orderkey", "o_orderdate")


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand <= 'Brand#3'")
def filter_text_order(spark, sf):
    return E.filter_rows(table(spark, sf, "part"), keep="p_brand lte 'Brand#3'").select("p_partkey", "p_brand")


@query("SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount > l_tax")
def filter_col_ref(spark, sf):
    return E.filter_rows(table(spark, sf, "lineitem"), keep="l_discount gt $l_tax").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax"
    )


# ---- lookups and splits ----------------------------------------------------


@query("""
    SELECT o_orderkey, c_name, c_mktsegment FROM orders
    LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING'
""")
def lookup_left(spark, sf):
    return L.lookup(
        table(spark, sf, "orders"),
        table(spark, sf, "customer"),
        on={"o_custkey": "c_custkey"},
        columns=["c_name", "c_mktsegment"],
        where="c_mktsegment = :segment",
        params={"segment": "BUILDING"},
    ).select("o_orderkey", "c_name", "c_mktsegment")


@query("""
    SELECT s_suppkey, n_name FROM supplier
    JOIN nation ON n_nationkey > s_nationkey AND n_nationkey <= s_nationkey + 2
""")
def lookup_range(spark, sf):
    return L.range_lookup(
        table(spark, sf, "supplier"),
        table(spark, sf, "nation"),
        point="n_nationkey",
        low=F.col("s_nationkey"),
        high=F.col("s_nationkey") + 2,
        width=2,
        columns=["n_name"],
        closed=(False, True),
    ).select("s_suppkey", "n_name")


@query("""
    SELECT o_orderkey, l_partkey, l_quantity FROM orders LEFT JOIN (
        SELECT l_orderkey, l_partkey, l_quantity, row_number() OVER (
            PARTITION BY l_orderkey ORDER BY l_quantity, l_partkey) AS rn FROM lineitem) x
    ON l_orderkey = o_orderkey AND rn <= 3
""")
def lookup_limit(spark, sf):
    return L.lookup(
        table(spark, sf, "orders").select("o_orderkey"),
        table(spark, sf, "lineitem"),
        on={"o_orderkey": "l_orderkey"},
        columns=["l_partkey", "l_quantity"],
        limit=3,
        order=["l_quantity", "l_partkey"],
    )


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def split_header(spark, sf):
    return S.split_headers(table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


@query("SELECT l_partkey, l_quantity, l_extendedprice FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def split_detail(spark, sf):
    return S.split_details(
        table(spark, sf, "orders"),
        table(spark, sf, "lineitem"),
        "o_orderkey",
        "l_orderkey",
        ["l_partkey", "l_quantity", "l_extendedprice"],
        limit=None,
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) x
    WHERE rn <= 2
""")
def split_detail_limit(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return first_n(lines, ["l_orderkey"], 2, ["l_linenumber"])


# ---- upserts ---------------------------------------------------------------


def _upsert_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored orders, and incoming prices: some known, some changed, some new."""
    orders = table(spark, sf, "orders")
    target = orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus", "o_totalprice")
    source = orders.where("o_orderstatus <> 'F'").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice")
    )
    return target, source


_MERGED = """
    SELECT coalesce(s.k, t.o_orderkey) AS o_orderkey, t.o_orderstatus,
           CASE WHEN s.k IS NOT NULL THEN s.p ELSE t.o_totalprice END AS o_totalprice
    FROM (SELECT * FROM orders WHERE o_orderstatus <> 'P') t
    FULL JOIN (SELECT o_orderkey AS k, o_totalprice + 1 AS p FROM orders WHERE o_orderstatus <> 'F') s
    ON t.o_orderkey = s.k
"""


@query(_MERGED)
def upsert_merge(spark, sf):
    target, source = _upsert_sides(spark, sf)
    return U.merge(target, source, ["o_orderkey"], small_source=False)


@query(_MERGED)
def upsert_merge_small(spark, sf):
    target, source = _upsert_sides(spark, sf)
    return U.merge(target, source, ["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus = 'P'")
def upsert_inserts(spark, sf):
    return U.inserts(*_upsert_sides(spark, sf), ["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderstatus = 'O'")
def upsert_updates(spark, sf):
    return U.updates(*_upsert_sides(spark, sf), ["o_orderkey"])


@query("SELECT DISTINCT o_custkey FROM orders")
def upsert_keys_only(spark, sf):
    orders = table(spark, sf, "orders")
    target = orders.where("o_orderstatus = 'F'").select("o_custkey").distinct()
    return U.merge(target, dedup_last(orders.select("o_custkey"), ["o_custkey"]), ["o_custkey"])


@query(
    """
    SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
        FROM lineitem) x WHERE rn = 1
    """,
    name="dedup_last",
)
def _dedup_last(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"
    )
    return dedup_last(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# ---- marks, metrics, unions ------------------------------------------------


@query("SELECT max(o_orderkey) AS max_id, max(o_orderdate) AS max_created FROM orders")
def watermark_max(spark, sf):
    return W.max_marks(table(spark, sf, "orders"), {"max_id": "o_orderkey", "max_created": "o_orderdate"})


@query("SELECT greatest(CAST(20000 AS BIGINT), max(o_orderkey)) AS max_id FROM orders")
def watermark_advance(spark, sf):
    marks = W.max_marks(table(spark, sf, "orders"), {"max_id": "o_orderkey"})
    return marks.select(W.advance_column(20000, F.col("max_id"), T.LongType()).alias("max_id"))


@query("""
    SELECT 'order' AS target_table, count(*) AS n FROM orders
    UNION ALL SELECT 'order_item', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def run_metrics(spark, sf):
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    details = S.split_details(orders, lines, "o_orderkey", "l_orderkey", ["l_partkey"], limit=None)
    return R.table_counts({"order": S.split_headers(orders), "order_item": details})


@query("""
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
    FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def union_normalise(spark, sf):
    customer = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    supplier = table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    return M.union_normalised([customer, supplier])


@query("SELECT 'evt_' || event_type AS target_table, count(*) AS n FROM events GROUP BY event_type")
def fanout_counts(spark, sf):
    tag = F.concat(F.lit("evt_"), F.col("event_type"))
    events = table(spark, sf, "events").select("event_id", tag.alias(E.TABLE_TAG))
    return R.tagged_counts(events)


@query("""
    SELECT event_id, CASE WHEN ts = date_trunc('day', ts) THEN strftime(ts, '%Y-%m-%d')
        WHEN ts = date_trunc('second', ts) THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_text FROM events
""")
def date_text(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", moment_text(F.col("ts"), events.schema["ts"].dataType).alias("ts_text"))


@query("SELECT count(DISTINCT l_orderkey) AS n_keys, CAST(1 AS BIGINT) AS max_parts_per_key FROM lineitem")
def route_buckets(spark, sf):
    routed = R.route(table(spark, sf, "lineitem").select("l_orderkey"), 8, ["l_orderkey"])
    placed = routed.select("l_orderkey", F.spark_partition_id().alias("part")).distinct()
    per_key = placed.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("parts"))
    return per_key.agg(F.count(F.lit(1)).alias("n_keys"), F.max("parts").alias("max_parts_per_key"))


# ---- sinks -----------------------------------------------------------------


@query("SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def sink_full(spark, sf):
    customer = table(spark, sf, "customer")
    sink = PathSink(spark, fresh_dir(spark, "sink-full"))
    sink.full(customer.select("c_custkey", "c_name"), "r1")
    sink.full(customer.where("c_acctbal >= 0").select("c_custkey", "c_name"), "r2")
    return read_target(spark, sink.path)


@query("""
    SELECT c_custkey, c_name FROM customer
    UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0
""")
def sink_append(spark, sf):
    customer = table(spark, sf, "customer")
    sink = PathSink(spark, fresh_dir(spark, "sink-append"))
    sink.append(customer.select("c_custkey", "c_name"), "r1")
    sink.append(customer.where("c_acctbal >= 0").select("c_custkey", "c_name"), "r2")
    return read_target(spark, sink.path)


@query(_MERGED)
def sink_upsert(spark, sf):
    target, source = _upsert_sides(spark, sf)
    sink = PathSink(spark, fresh_dir(spark, "sink-upsert"), ("o_orderkey",))
    sink.upsert(target, "r1")
    sink.upsert(source, "r2")
    return read_target(spark, sink.path)


@query(_MERGED)
def sink_upsert_changes(spark, sf):
    """The same after the target came by two appends: only the buckets that the batch touches are replaced."""
    target, source = _upsert_sides(spark, sf)
    sink = PathSink(spark, fresh_dir(spark, "sink-changes"), ("o_orderkey",))
    sink.append(target.where("o_orderkey % 2 = 0"), "r1")
    sink.append(target.where("o_orderkey % 2 <> 0"), "r2")
    sink.upsert(source, "r3")
    return read_target(spark, sink.path)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def incr_two_runs(spark, sf):
    """Old orders first; a second run finds the rest above the stored mark."""
    work = fresh_dir(spark, "incr")
    old = table(spark, sf, "orders").where("o_orderdate <= '1998-06-01'")
    PathSink(spark, f"{work}/source/orders").full(old, "seed1")
    doc = {"name": "two_runs", "sync": {"mode": "upsert", "state": {"m": {"type": "max", "column": "o_orderdate"}}}}
    doc["source"] = {"connection": "in", "table": "orders", "where": "o_orderdate > ${state.m}",
                     "columns": "o_orderkey,o_totalprice", "primary_key": "o_orderkey"}
    doc["target"] = {"connection": "out", "table": "copy", "columns": "o_orderkey,o_totalprice",
                     "primary_key": "o_orderkey"}
    job = Job.from_dict(doc)
    files = {n: Connection.parse(n, {"type": "files", "path": f"{work}/{p}"}) for n, p in (("in", "source"), ("out", "target"))}
    runner = Runner(spark, X.Tables(spark, files), f"{work}/state")
    runner.run(job, CLOCK, "r1")
    PathSink(spark, f"{work}/source/orders").full(table(spark, sf, "orders"), "seed2")
    runner.run(job, CLOCK, "r2")
    return read_target(spark, f"{work}/target/copy")


@query("""
    SELECT user_id, event_id, ts, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) x WHERE rn = 1
""")
def stream_upsert(spark, sf):
    """Events arrive in three portions, oldest first; each becomes a micro-batch, an upsert."""
    work = fresh_dir(spark, "stream")
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "value")
    doc = {"name": "latest", "sync": {"mode": "upsert", "order_by": "ts,event_id"}}
    doc["source"] = {"connection": "out", "table": "events"}
    doc["target"] = {"connection": "out", "table": "latest", "primary_key": "user_id"}
    files = {"out": Connection.parse("out", {"type": "files", "path": f"{work}/out"})}
    runner = Runner(spark, X.Tables(spark, files), f"{work}/state")
    early, late = F.col("ts") < F.lit("2024-01-11"), F.col("ts") >= F.lit("2024-01-21")
    for portion in (early, ~early & ~late, late):
        events.where(portion).write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/in")
        microbatch.start(runner, Job.from_dict(doc), stream, f"{work}/checkpoint").awaitTermination()
    return read_target(spark, f"{work}/out/latest")


@query("SELECT event_id, user_id, ts, value FROM events")
def stream_late_rows(spark, sf):
    """Events arrive in three portions; the later ones bring some of the last days again, and some that were held back.

    Every event inside the bound of three days is appended once.
    """
    work = fresh_dir(spark, "late")
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    day = lambda n: F.col("ts") < F.expr(f"TIMESTAMP'2024-01-01 00:00:00' + INTERVAL {n} DAYS")
    held = F.col("event_id") % 50 == 0
    portions = [
        events.where(day(10) & ~(~day(8) & held)),
        events.where((day(20) & ~(~day(18) & held) & ~day(10)) | (day(10) & ~day(8))),
        events.where(~day(20) | (day(20) & ~day(18))),
    ]
    doc = {"name": "late", "sync": {"mode": "append"}}
    doc["source"] = {"connection": "out", "table": "events", "primary_key": "event_id"}
    doc["target"] = {"connection": "out", "table": "once"}
    files = {"out": Connection.parse("out", {"type": "files", "path": f"{work}/out"})}
    runner = Runner(spark, X.Tables(spark, files), f"{work}/state")
    late = microbatch.Lateness("ts", "3 days")
    for portion in portions:
        portion.write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{work}/in")
        microbatch.start(runner, Job.from_dict(doc), stream, f"{work}/checkpoint", late=late).awaitTermination()
    return read_target(spark, f"{work}/out/once")


# ---- steps -----------------------------------------------------------------


@query("""
    SELECT event_id, event_type, CAST(c AS BIGINT) AS copy_no FROM events
    JOIN (VALUES (0), (1)) v(c) ON c = 0 OR event_type = 'purchase' WHERE event_type <> 'error'
""")
def step_custom(spark, sf):
    # Defined here, so that it travels to the executors by value.
    def copies(row):
        """Errors vanish, purchases come twice, everything else once."""
        if row["event_type"] != "error":
            for n in range(2 if row["event_type"] == "purchase" else 1):
                yield "", {**row, "copy_no": n}

    schema = T._parse_datatype_string("event_id bigint, event_type string, copy_no bigint")
    step = E.RowStep(copies, {"": schema})
    events = table(spark, sf, "events").select("event_id", "event_type")
    return step(E.StepContext(), {"": events})[""]


@query("""
    SELECT event_id, event_type, CAST(c AS BIGINT) AS copy_no FROM events
    JOIN (VALUES (0), (1)) v(c) ON c = 0 OR event_type = 'purchase' WHERE event_type <> 'error'
""")
def step_batch(spark, sf):
    """The same as step_custom, by code that sees Arrow tables."""

    def copies(batch):
        import pyarrow as pa
        import pyarrow.compute as pc

        kept = batch.filter(pc.not_equal(batch["event_type"], "error"))
        again = batch.filter(pc.equal(batch["event_type"], "purchase"))
        numbered = [t.append_column("copy_no", pa.repeat(pa.scalar(n), t.num_rows)) for n, t in enumerate((kept, again))]
        return {"": pa.concat_tables(numbered)}

    schema = T._parse_datatype_string("event_id bigint, event_type string, copy_no bigint")
    events = table(spark, sf, "events").select("event_id", "event_type")
    return E.BatchStep(copies, {"": schema})(E.StepContext(), {"": events})[""]


@query("""
    SELECT 'evt_' || event_type AS target_table, event_id FROM events
    UNION ALL SELECT 'all', event_id FROM events WHERE value >= 50
""")
def fanout_write(spark, sf):
    """A step for several tables in a job: its code runs once, one write deals the rows, each table reads its partition."""
    kinds = [r[0] for r in table(spark, sf, "events").select("event_type").distinct().collect()]

    def deal(batch):
        import pyarrow.compute as pc

        out = {f"evt_{k}": batch.filter(pc.equal(batch["event_type"], k)) for k in pc.unique(batch["event_type"]).to_pylist()}
        return {**out, "all": batch.filter(pc.greater_equal(batch["value"], 50.0))}

    schema = T._parse_datatype_string("event_id bigint")
    E.register_step("deal_events")(lambda config: E.BatchStep(deal, {t: schema for t in ("all", *[f"evt_{k}" for k in kinds])}))
    work = fresh_dir(spark, "fanout")
    files = {"in": Connection.parse("in", {"type": "files", "path": sf, "pattern": "{table}.parquet"}), "out": Connection.parse("out", {"type": "files", "path": work})}
    doc = {"name": "fanout", "etl": [{"plugin": "deal_events"}], "sync": {"mode": "append"}}
    doc["source"] = {"connection": "in", "table": "events", "columns": "event_id,event_type,value"}
    doc["target"] = {"connection": "out", "table": "events"}
    result = Runner(spark, X.Tables(spark, files), f"{work}/state").run(Job.from_dict(doc), CLOCK, "r1")
    return M.union_normalised([read_target(spark, f"{work}/{t}").select(F.lit(t).alias("target_table"), "event_id") for t in result.written])


@query("""
    SELECT 'seen' AS target_table, event_id, CAST(NULL AS DOUBLE) AS paid FROM events
    UNION ALL SELECT 'paid', event_id, value FROM events WHERE event_type = 'purchase'
""")
def step_custom_tables(spark, sf):
    def split(row):
        """Every event is seen, purchases are paid as well."""
        yield "", {"event_id": row["event_id"]}
        if row["event_type"] == "purchase":
            yield "paid", {"event_id": row["event_id"], "paid": row["value"]}

    schemas = {"": "event_id bigint", "paid": "event_id bigint, paid double"}
    step = E.RowStep(split, {t: T._parse_datatype_string(s) for t, s in schemas.items()})
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    out = step(E.StepContext(), {"": events})
    return M.union_normalised([df.select(F.lit(t or "seen").alias("target_table"), "*") for t, df in out.items()])


@query("""
    SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
           'lake' AS origin FROM orders WHERE o_totalprice >= 1000
""")
def step_chain(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    specs = [
        {"filter": {"keep": "o_totalprice gte 1000"}},
        {"builtin": "rename", "config": {"column": [
            {"from": "o_orderkey", "to": "order_id"},
            {"from": "o_custkey", "to": "user_id"},
            {"from": "o_totalprice", "to": "amount"},
        ]}},
        {"cast": {"column": [{"name": "amount", "type": "decimal(18,2)"}]}},
        {"set": {"constant": {"origin": "lake"}}},
    ]
    steps = E.chain([E.StepSpec.parse(s).build() for s in specs])
    return steps(E.StepContext(), {"": orders})[""]


@query("SELECT o_orderkey, 'tpch' AS _source_connection, 'orders' AS _source_table FROM orders")
def provenance(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return E.with_provenance(orders, E.StepContext(source_connection="tpch", source_table="orders"))


# ---- the whole job ---------------------------------------------------------

SALES_JOB = {
    "name": "sales_lake",
    "source": {
        "connection": "tpch",
        "table": "orders",
        "where": "o_orderdate >= ${state.seen} or o_orderkey > ${state.top}",
        "primary_key": ["o_orderkey"],
        "columns": "o_orderkey,o_custkey,o_orderpriority,o_totalprice",
    },
    "target": {
        "connection": "lake",
        "table": "sale",
        "columns": "sale,buyer,urgency,total",
        "primary_key": ["sale"],
        "keys": {"sale_line": ["l_orderkey", "l_linenumber"]},
    },
    "sync": {
        "mode": "upsert",
        "state": {"seen": {"type": "max", "column": "o_orderdate"}, "top": {"type": "max", "column": "o_orderkey"}},
    },
    "etl": [
        {"filter": {"drop": "urgency eq 5-LOW"}},
        {"cast": {"column": [{"name": "total", "type": "decimal(16,3)"}, {"name": "buyer", "type": "string"}]}},
        {
            "plugin": "order_split",
            "config": {
                "detail_table": "sale_line",
                "source_detail_table": "lineitem",
                "detail_columns": ["l_suppkey", "l_extendedprice"],
                "parent_key": "sale",
                "child_key": "l_orderkey",
                "keep": ["sale", "buyer", "total"],
            },
        },
    ],
}


@query("""
    SELECT 'sale' AS target_table, o_orderkey AS sale, CAST(o_custkey AS VARCHAR) AS buyer,
           CAST(o_totalprice AS DECIMAL(16,3)) AS total, CAST(NULL AS BIGINT) AS supplier,
           CAST(NULL AS DOUBLE) AS price FROM orders WHERE o_orderpriority <> '5-LOW'
    UNION ALL
    SELECT 'sale_line', CAST(NULL AS BIGINT), NULL, CAST(NULL AS DECIMAL(16,3)), l_suppkey, l_extendedprice
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderpriority <> '5-LOW'
""")
def flagship_order_sync(spark, sf):
    """The sample job's first run: both target tables of its plan, tagged and united."""
    job, runner = Job.from_dict(SALES_JOB), Runner(spark, given_tables(spark, sf), "unused")
    branches = runner.plan(job, runner.read(job, CLOCK, {}))
    header = branches["sale"].select(F.lit("sale").alias("target_table"), "sale", "buyer", "total")
    lines = branches["sale_line"].select(
        F.lit("sale_line").alias("target_table"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_extendedprice").alias("price"),
    )
    return M.union_normalised([header, lines])


@query("SELECT o_orderkey, o_custkey FROM orders")
def incr_first_run_keys(spark, sf):
    """A first run above an integer mark reads every order, key 0 too."""
    doc = {"name": "first", "sync": {"mode": "append", "state": {"m": {"type": "max", "column": "o_orderkey"}}}}
    doc["source"] = {"connection": "tpch", "table": "orders", "where": "o_orderkey > ${state.m}", "columns": "o_orderkey,o_custkey"}
    doc["target"] = {"connection": "tpch", "table": "copy"}
    return Runner(spark, given_tables(spark, sf), "unused").read(Job.from_dict(doc), CLOCK, {}).select("o_orderkey", "o_custkey")


@query("""
    SELECT c_custkey, c_name FROM customer
    UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0
""")
def sink_append_replay(spark, sf):
    """Each append counts once, also when it is repeated after other writes; '1' is not 'r-1'."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    sink = PathSink(spark, fresh_dir(spark, "sink-replay"), ("c_custkey",))
    every, some = customer.drop("c_acctbal"), customer.where("c_acctbal >= 0").drop("c_acctbal")
    sink.append(every, "r-1")
    sink.append(some, "1")
    sink.upsert(some, "u")
    sink.append(every, "r-1")
    sink.append(some, "1")
    return read_target(spark, sink.path)


@query("""
    SELECT event_id, k FROM (SELECT event_id, nullif(user_id % 7, 0) AS k,
        row_number() OVER (PARTITION BY user_id % 7 ORDER BY event_id DESC) AS rn FROM events) x
    WHERE rn = 1 OR k IS NULL
""")
def dedup_null_keys(spark, sf):
    """The last event of each key; every event without a key."""
    events = table(spark, sf, "events").selectExpr("event_id", "nullif(user_id % 7, 0) AS k")
    return dedup_last(events, ["k"], ["event_id"])


@query("""
    SELECT CAST(NULL AS BIGINT) AS k, o_custkey AS v FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, -o_custkey FROM orders
""")
def upsert_null_keys_whole(spark, sf):
    """All orders into all orders, a third of which have no key and stay alone."""
    orders = table(spark, sf, "orders")
    target = orders.selectExpr("CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS k", "o_custkey AS v")
    source = orders.selectExpr("o_orderkey AS k", "-o_custkey AS v")
    return U.merge(target, source, ["k"], small_source=False)


@query("""
    SELECT o_orderkey, o_custkey, c_name, l_partkey FROM orders
    LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey
    LEFT JOIN (SELECT l_orderkey, l_partkey, row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey) AS rn FROM lineitem) l
    ON o_orderkey = l_orderkey AND rn <= 2
""")
def job_lookup(spark, sf):
    """Two lookups of a job document: one under a bound condition, one with a limit per key."""
    lookups = [
        {"lookup": {"table": "customer", "on": {"o_custkey": "c_custkey"}, "columns": ["c_name"],
                    "where": "c_acctbal > :least", "params": {"least": 0}}},
        {"lookup": {"table": "lineitem", "on": {"o_orderkey": "l_orderkey"}, "columns": ["l_partkey"],
                    "limit": 2, "order": ["l_extendedprice", "l_partkey"]}},
    ]
    doc = {"name": "looked_up", "etl": lookups, "sync": {"mode": "append"}}
    doc["source"] = {"connection": "tpch", "table": "orders", "columns": "o_orderkey,o_custkey"}
    doc["target"] = {"connection": "tpch", "table": "out"}
    job, runner = Job.from_dict(doc), Runner(spark, given_tables(spark, sf), "unused")
    return runner.plan(job, runner.read(job, CLOCK, {}))["out"]
