from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError, TemplateError
from rowtide.plans.job import Job, names
from rowtide.plans.templates import Template, clock_text
from rowtide.sources import dialects as D
from rowtide.sources.connections import Connection, expand_env, load_connections

NOW = dt.datetime(2024, 1, 1, 12)


def template(marks=None, env=None):
    marks = marks or {}

    def state(key):
        if key not in marks:
            raise TemplateError(f"state key {key!r} is not declared")
        return marks[key]

    return Template(state, NOW, env or {})


MARKS = {
    "max_id": V.Constant(42, T.LongType()),
    "t": V.Constant(dt.datetime(2024, 1, 1, 1, 2, 3), T.TimestampNTZType()),
    "s": V.Constant("it's", T.StringType()),
    "d": V.Constant(Decimal("10.50"), T.DecimalType(10, 2)),
}


def test_state_and_env():
    t = template(MARKS, {"REGION": "north", "T": "orders", "Q": "o'x"})
    text = "region IN ('${env.REGION}', 'all') AND ticket >= ${state.max_id}"
    assert t.render(text) == "region IN ('north', 'all') AND ticket >= 42"
    bound = t.bind(text)
    assert bound.sql == "region IN ('north', 'all') AND ticket >= CAST(:state_max_id AS bigint)"
    assert bound.args == {"state_max_id": "42"}
    assert t.bind("select * from ${env.T}").sql == "select * from orders"
    assert t.bind("x = '${env.Q}'").sql == "x = 'o''x'"
    assert t.bind("x = ${env.Q}") .args == {"env_Q": "o'x"}


def test_rendered_marks():
    t = template(MARKS)
    assert t.render("${state.t} ${state.s} ${ state.d }") == "'2024-01-01 01:02:03' 'it''s' '10.50'"


@pytest.mark.parametrize(
    ("expr", "want"),
    [
        ("now('%Y-%m-%d %H:%M:%S')", "2024-01-01 12:00:00"),
        ("now('%Y-%m-%d') -1D", "2023-12-31"),
        ("now('%H:%M:%S') -30S", "11:59:30"),
        ("now('%F %T') +2H", "2024-01-01 14:00:00"),
        ("now('%F')2D", "2024-01-03"),
        ("now('%y%m%d%%') 10M and more", "240101%"),
    ],
)
def test_clock(expr, want):
    assert clock_text(expr, NOW) == want
    assert template().render("${sys." + expr + "}") == f"'{want}'"
    bound = template().bind("${sys." + expr + "}")
    assert list(bound.args.values()) == [want]


@pytest.mark.parametrize(
    "text",
    ["${sys.now(%Y)}", "${sys.now('%Q')}", "${sys.now('%')}", "${sys.now('%Y') -D}", "${sys.now('%Y') -1W}",
     "${sys.now('%Y') 999999999999D}", "${nope.x}", "${env.NOT_SET}", "${state.other}"],
)
def test_bad_tokens(text):
    for act in (template(MARKS).bind, template(MARKS).render):
        with pytest.raises(TemplateError):
            act(text)


def test_token_scan():
    t = template(MARKS)
    assert t.render("a ${state.max_id} b ${unfinished") == "a 42 b ${unfinished"
    assert t.render("no tokens") == "no tokens"
    with pytest.raises(TemplateError):
        t.bind("x = '${state.max_id}'")


def test_different_keys_get_different_parameters():
    marks = {"a-b": V.Constant(1, T.LongType()), "a_b": V.Constant(2, T.LongType())}
    assert sorted(template(marks).bind("${state.a-b} ${state.a_b}").args.values()) == ["1", "2"]


def test_bound_queries_run(spark):
    spark.range(100).createOrReplaceTempView("ids")
    bound = template(MARKS).bind("SELECT count(*) FROM ids WHERE id > ${state.max_id} AND 's' <> ${state.s}")
    assert spark.sql(bound.sql, args=dict(bound.args)).first()[0] == 57
    bound = template(MARKS).bind("SELECT ${state.t} AS t, ${state.d} AS d, ${sys.now('%F')} AS n")
    row = spark.sql(bound.sql, args=dict(bound.args)).first()
    assert tuple(row) == (MARKS["t"].value, Decimal("10.50"), "2024-01-01")


# ---- connections -----------------------------------------------------------


def test_expand_env():
    env = {"PW": "hidden"}
    assert expand_env("${PW}", env) == "hidden" and expand_env("${env.PW}", env) == "hidden"
    assert expand_env("x${UNSET}", env) == "x${UNSET}"
    assert expand_env("${open", env) == "${open"


DOC = """
connections:
  my: {type: mysql, host: h, database: erp, username: sync, password: 123456, max_pool_size: 8,
       params: {charset: utf8mb4}, ssl_mode: require}
  pg: {type: postgresql, port: 5433, database: test, schema: app, username: u, password: "${PW}", params: {ssl_mode: disable}}
  ora: {type: oracle, host: o, database: SVC, schema: E"RP, username: u, password: p}
  lake: {type: files, path: /data/lake/, pattern: "{table}.parquet"}
"""


def test_connections():
    import yaml

    conns = load_connections(yaml.safe_load(DOC), {"PW": "hidden"})
    my, pg, ora = (conns[n].jdbc_options() for n in ("my", "pg", "ora"))
    assert my["url"] == "jdbc:mysql://h:3306/erp" and my["password"] == "123456"
    assert my["characterEncoding"] == "UTF-8" and my["sslMode"] == "REQUIRED" and my["numPartitions"] == "8"
    assert pg["url"] == "jdbc:postgresql://localhost:5433/test" and pg["password"] == "hidden"
    assert pg["currentSchema"] == "app" and pg["sslmode"] == "disable"
    assert ora["url"] == "jdbc:oracle:thin:@//o:1521/SVC"
    assert ora["sessionInitStatement"] == 'ALTER SESSION SET CURRENT_SCHEMA = "E""RP"'
    assert conns["lake"].path == "/data/lake" and not conns["lake"].is_database
    assert "hidden" not in repr(conns) and "123456" not in repr(conns)


@pytest.mark.parametrize(
    "raw",
    [{}, {"type": "sqlite"}, {"type": "files"}, {"type": "jdbc", "host": "h"}, {"type": "mysql", "host": ""}],
)
def test_bad_connections(raw):
    with pytest.raises(ConfigError):
        Connection.parse("c", raw)


def test_bad_charset_and_document():
    with pytest.raises(ConfigError):
        Connection.parse("c", {"type": "mysql", "params": {"charset": "klingon"}}).jdbc_options()
    with pytest.raises(ConfigError):
        load_connections({})


# ---- statements ------------------------------------------------------------


def test_upsert_statements():
    sql = {d: D.upsert_sql(d, "t", "s", ["id", "a"], ["id"], "r") for d in ("mysql", "postgresql", "oracle")}
    rows = (
        'SELECT "id", "a" FROM (SELECT "id", "a", row_number() OVER (PARTITION BY "r" ORDER BY "r") AS rt_n '
        'FROM "s") rt_s WHERE rt_n = 1'
    )
    assert sql["mysql"] == (
        f"INSERT INTO `t` (`id`, `a`) {rows.replace(chr(34), '`')} ON DUPLICATE KEY UPDATE `a` = VALUES(`a`)"
    )
    assert sql["postgresql"] == (
        f'INSERT INTO "t" ("id", "a") {rows} ON CONFLICT ("id") DO UPDATE SET "a" = EXCLUDED."a"'
    )
    assert sql["oracle"] == (
        f'MERGE INTO "t" t USING ({rows}) s ON (t."id" = s."id") '
        'WHEN MATCHED THEN UPDATE SET t."a" = s."a" WHEN NOT MATCHED THEN INSERT ("id", "a") VALUES (s."id", s."a")'
    )
    keys = {d: D.upsert_sql(d, "t", "s", ["id"], ["id"], "r") for d in ("mysql", "postgresql", "oracle")}
    assert "NOT EXISTS" in keys["mysql"] and keys["postgresql"].endswith("DO NOTHING") and "UPDATE" not in keys["oracle"]


def test_oracle_upsert_means_what_it_says():
    """The MERGE form, in DuckDB, which wants the updated column unqualified."""
    import duckdb

    con = duckdb.connect()
    con.execute('CREATE TABLE t (id BIGINT, a VARCHAR); CREATE TABLE s (id BIGINT, a VARCHAR, r BIGINT)')
    con.execute("INSERT INTO t VALUES (1, 'x'), (2, 'y'); INSERT INTO s VALUES (2, 'z', 0), (3, 'n', 1), (3, 'n', 1)")
    merge = D.upsert_sql("oracle", "t", "s", ["id", "a"], ["id"], "r").replace('SET t."a"', 'SET "a"')
    for _ in range(2):
        con.execute(merge)
        assert con.execute("SELECT * FROM t ORDER BY id").fetchall() == [(1, "x"), (2, "z"), (3, "n")]


def test_oracle_writes_name_their_schema():
    ora = Connection.parse("o", {"type": "oracle", "schema": "ERP"})
    assert D.table_name(ora, "t") == '"ERP"."t"'
    assert D.table_name(Connection.parse("p", {"type": "postgresql", "schema": "app"}), "t") == '"t"'


def test_reads_and_pages():
    assert D.select_sql("mysql", "t`x", ["a"], "a > 1") == "SELECT `a` FROM `t``x` WHERE a > 1"
    assert D.select_sql("oracle", "t") == 'SELECT * FROM "t"'
    assert D.page_sql("mysql", "SELECT 1;", ["a", "b"], 20, 10) == (
        "SELECT * FROM (SELECT 1) rt_q ORDER BY `a`, `b` LIMIT 10 OFFSET 20"
    )
    assert D.page_sql("oracle", "SELECT 1", ["a"], 20, 10) == (
        'SELECT * FROM (SELECT 1) rt_q ORDER BY "a" OFFSET 20 ROWS FETCH NEXT 10 ROWS ONLY'
    )


# ---- jobs ------------------------------------------------------------------

JOB = """
name: people
writers: 4
source:
  connection: a
  table: person
  primary_key: [id]
  columns: " id , name ,"
  where: id > ${state.max_id}
target: {connection: b, table: people, primary_key: id, columns: [id, label], keys: {extra: "a,b"}}
sync:
  mode: UPSERT
  state:
    max_id: {type: max, column: id}
etl:
  cast: {column: [{name: id, type: string}]}
schedule: {every: 10 seconds}
"""


def test_job_document():
    job = Job.from_yaml(JOB)
    assert job.source.columns == ("id", "name") and job.source.primary_key == ("id",)
    assert job.target.columns == ("id", "label") and job.target.keys_of("extra") == ("a", "b")
    assert job.target.keys_of("people") == ("id",) and job.target.keys_of("other") == ()
    assert job.mode == "upsert" and job.tracked() == {"max_id": "id"} and job.writers == 4
    assert [s.name for s in job.etl] == ["cast"] and job.schedule == "10 seconds" and job.enabled
    assert job.order_of("people", ["id", "label"]) == ()


def test_names():
    assert names(" id , name ,") == ("id", "name") and names(None) == () and names(["a", " b "]) == ("a", "b")


@pytest.mark.parametrize(
    "change",
    [
        {"name": None}, {"source": {}}, {"source": {"connection": "a"}}, {"source": {"connection": "a", "select": "  "}},
        {"target": {"connection": "b"}}, {"target": {"connection": "b", "table": "t"}}, {"sync": {"mode": "merge"}},
        {"sync": {"state": {"m": {"type": "min", "column": "id"}}}}, {"sync": {"state": {"m": {"type": "max"}}}},
        {"etl": [{"nope": {}}]}, {"etl": [{"filter": {"keep": "x"}}]},
    ],
)
def test_bad_jobs(change):
    import yaml

    with pytest.raises(ConfigError):
        Job.from_dict({**yaml.safe_load(JOB), **change})
    with pytest.raises(ConfigError):
        Job.from_yaml("a: [")


def test_what_is_not_used_is_said():
    doc = {"name": "j", "source": {"connection": "c", "table": "t", "select": "select 1", "where": "a > 1"}, "sync": {"mode": "append"},
           "target": {"connection": "c", "table": "t"}, "schedule": {"cron": "* * * * *"}}
    with pytest.warns(UserWarning) as said:
        Job.from_dict(doc)
    assert [("cron" in str(w.message), "where" in str(w.message)) for w in said] == [(True, False), (False, True)]


@pytest.mark.parametrize(
    ("text", "quoted"),
    [
        ("a > ${env.X}", False), ("a > '${env.X}'", True), ("-- it's\n a > ${env.X}", False), ("/* don't */ a > ${env.X}", False),
        ("a = 'it''s' AND b > ${env.X}", False), ("a = 'it\\'s' AND b > ${env.X}", False), ('"o\'clock" > ${env.X}', False),
        ("`o'clock` = '-${env.X}-'", True),
    ],
)
def test_quotes_are_told_from_comments_and_names(text, quoted):
    """A value inside quotes is put into the text; outside it becomes a parameter."""
    bound = Template(lambda key: None, dt.datetime(2024, 1, 1), {"X": "a b"}).bind(text)
    assert (bound.args == {}) == quoted and ("a b" in bound.sql) == quoted


def test_partition_by():
    doc = {"name": "j", "source": {"connection": "c", "table": "t", "primary_key": "k", "partition_column": "k", "partition_by": "depth"},
           "target": {"connection": "c", "table": "t", "primary_key": "k"}}
    assert Job.from_dict(doc).source.partition_by == "depth"
    doc["source"]["partition_by"] = "weight"
    with pytest.raises(ConfigError, match="partition_by"):
        Job.from_dict(doc)
