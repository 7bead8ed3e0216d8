"""The database side without a database server.

Statements of the sink run in DuckDB, which understands the PostgreSQL forms; the handle
below offers the few calls the sink makes.  Reads are checked by their options.
"""

from __future__ import annotations

import contextlib
import datetime as dt

import duckdb
import pytest
from frames import rows
from pyspark.sql import types as T

from rowtide import Connection, Job, Runner, Tables
from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.sinks import jdbc as sink_module
from rowtide.sinks.jdbc import JdbcSink, with_retry
from rowtide.sources import dialects, jdbc

PG = Connection.parse("pg", {"type": "postgresql", "database": "d", "max_pool_size": 3})


class Rows:
    def __init__(self, data):
        self.data, self.at = data, -1

    def next(self):
        self.at += 1
        return self.at < len(self.data)

    def getLong(self, i):  # noqa: N802
        return self.data[self.at][i - 1]

    def getString(self, name):  # noqa: N802
        return self.data[self.at][0]

    def close(self):
        pass


class Handle:
    """One database connection as the driver would offer it."""

    def __init__(self, con, fail=None):
        self.con, self.fail, self.auto, self.log = con, fail, True, []

    def createStatement(self):  # noqa: N802
        return self

    def executeUpdate(self, sql):  # noqa: N802
        self.log.append(sql)
        self.con.execute(sql)
        return 0

    def executeQuery(self, sql):  # noqa: N802
        return Rows(self.con.execute(sql).fetchall())

    def getMetaData(self):  # noqa: N802
        return self

    def getTables(self, catalog, schema, table, types):  # noqa: N802
        # Names are patterns here, as in every driver.
        return Rows(self.con.execute("SELECT table_name FROM duckdb_tables() WHERE table_name LIKE ? ESCAPE '\\'", [table]).fetchall())

    def getCatalog(self):  # noqa: N802
        return None

    def getSchema(self):  # noqa: N802
        return None

    def getSearchStringEscape(self):  # noqa: N802
        return "\\"

    def getAutoCommit(self):  # noqa: N802
        return self.auto

    def setAutoCommit(self, on):  # noqa: N802
        if self.auto and not on:
            self.con.execute("BEGIN")
        self.auto = on

    def commit(self):
        self.con.execute("COMMIT")
        if self.fail and self.fail.pop("after", None):
            raise OSError("the answer got lost")

    def rollback(self):
        with contextlib.suppress(duckdb.Error):
            self.con.execute("ROLLBACK")

    def close(self):
        pass


@pytest.fixture
def db(monkeypatch):
    con = duckdb.connect()
    con.execute('CREATE TABLE t (id BIGINT PRIMARY KEY, a VARCHAR, b VARCHAR)')
    con.execute("CREATE TABLE log (id BIGINT, a VARCHAR)")
    state = {"fail": {}, "twice": False}

    @contextlib.contextmanager
    def session(spark, conn):
        yield Handle(con, state["fail"])

    def fill(self, df, stage):
        data = [tuple(r) for r in df.collect()]
        cols = ", ".join(f'"{c}"' for c in df.columns)
        for _ in range(2 if state["twice"] else 1):
            for r in data:
                con.execute(f'INSERT INTO "{stage}" ({cols}) VALUES ({", ".join("?" for _ in r)})', list(r))

    monkeypatch.setattr(jdbc, "session", session)
    monkeypatch.setattr(JdbcSink, "_fill", fill)
    monkeypatch.setattr(sink_module.time, "sleep", lambda s: None)
    state["con"] = con
    return state


def table(db, name="t"):
    return sorted(db["con"].execute(f"SELECT * FROM {name}").fetchall(), key=str)


def sink(spark, name="t", keys=("id",)):
    return JdbcSink(spark, PG, name, keys, retry=1)


@pytest.mark.parametrize("twice", [False, True])
def test_upsert(spark, db, twice):
    db["con"].execute("INSERT INTO t VALUES (1, 'a', 'x'), (2, 'b', 'y')")
    db["twice"] = twice
    batch = spark.createDataFrame([(2, "c"), (3, "d"), (3, "e")], "id long, a string")
    for run in ("r1", "r1", "r2"):
        assert sink(spark).write(batch, "upsert", run) == 2
        assert table(db) == [(1, "a", "x"), (2, "c", "y"), (3, "e", None)]
    assert sink(spark).write(batch.select("id"), "upsert", "r3") == 2
    assert table(db) == [(1, "a", "x"), (2, "c", "y"), (3, "e", None)]
    assert [r[0] for r in db["con"].execute("SELECT table_name FROM duckdb_tables()").fetchall()] == ["log", "t"]


@pytest.mark.parametrize("twice", [False, True])
def test_append_and_full(spark, db, twice):
    db["twice"] = twice
    batch = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, a string")
    assert sink(spark, "log", ()).write(batch, "append", "r1") == 3
    assert sink(spark, "log", ()).write(batch.limit(1), "append", "r2") == 1
    assert len(table(db, "log")) == 4
    assert sink(spark, "log", ()).write(batch, "full", "r3") == 3
    assert table(db, "log") == [(1, "a"), (1, "a"), (2, "b")]
    assert sink(spark, "log", ()).write(batch.limit(0), "full", "r4") == 0
    assert table(db, "log") == []


@pytest.mark.parametrize("mode", ["append", "full", "upsert"])
def test_a_lost_answer_is_not_applied_twice(spark, db, mode):
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id long, a string")
    db["fail"]["after"] = True
    assert sink(spark, "t").write(batch, mode, "r1") == 2
    assert table(db) == [(1, "a", None), (2, "b", None)]


def test_a_failed_change_is_rolled_back(spark, db):
    db["con"].execute("INSERT INTO t VALUES (1, 'a', 'x')")
    batch = spark.createDataFrame([(2, "b"), (1, "z")], "id long, a string")
    with pytest.raises(duckdb.ConstraintException):
        sink(spark, "t").write(batch, "append", "r1")
    assert table(db) == [(1, "a", "x")]


def test_refused(spark, db):
    batch = spark.createDataFrame([(1, "a")], "id long, a string")
    with pytest.raises(ConfigError):
        sink(spark, "t", ()).write(batch, "upsert", "r")
    with pytest.raises(ConfigError):
        sink(spark, "t").write(batch, "merge", "r")


def test_retry_backs_off():
    waits, calls = [], []

    def action():
        calls.append(1)
        if len(calls) < 4:
            raise OSError
        return "done"

    assert with_retry(action, 3, waits.append) == "done" and waits == [1, 2, 4]
    calls.clear()
    with pytest.raises(OSError):
        with_retry(action, 2, waits.append)
    assert len(calls) == 3


def test_an_append_takes_effect_once(spark, db):
    """Its run is kept in the target's transaction: repeated after anything, it is known."""
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id long, a string")
    for _ in range(2):
        assert sink(spark, "log", ()).write(batch, "append", "r'1") == 2
    assert sink(spark, "log", ()).write(batch.limit(1), "append", "r2") == 1
    assert sink(spark, "t").write(batch, "append", "r'1") == 2
    assert sink(spark, "log", ()).write(batch.limit(0), "append", "r'1") == 2
    assert sink(spark, "log", ()).write(batch.limit(0), "append", "r3") == 0
    assert len(table(db, "log")) == 3 and len(table(db)) == 2
    # What is rolled back leaves no run behind.
    with pytest.raises(duckdb.ConstraintException):
        sink(spark, "t").write(batch, "append", "r4")
    assert sorted(db["con"].execute("SELECT target_name, run_id, rows_written FROM rt_runs").fetchall()) == [
        ("log", "r'1", 2), ("log", "r2", 1), ("log", "r3", 0), ("t", "r'1", 2)
    ]


def test_a_broken_transfer_is_tried_again_from_an_empty_stage(spark, db, monkeypatch):
    real, calls = JdbcSink._fill, []

    def breaking(self, df, stage):
        calls.append(stage)
        real(self, df.limit(1) if len(calls) == 1 else df, stage)
        if len(calls) == 1:
            raise OSError("connection reset")

    monkeypatch.setattr(JdbcSink, "_fill", breaking)
    batch = spark.createDataFrame([(1, "a"), (2, "b")], "id long, a string")
    assert sink(spark, "t").write(batch, "upsert", "r1") == 2
    assert table(db) == [(1, "a", None), (2, "b", None)] and len(calls) == 2


def test_tables_are_known_by_exact_names(db):
    db["con"].execute("CREATE TABLE rtXrows (id BIGINT)")
    handle = Handle(db["con"])
    assert jdbc.has_table(handle, None, "rtXrows") and not jdbc.has_table(handle, None, "rt_rows")
    assert jdbc._exactly(handle, "a_b%c\\d") == "a\\_b\\%c\\\\d" and jdbc._exactly(handle, None) is None


def test_slices_of_equal_depth(db):
    """The database says where slices begin, also for text; the conditions are disjoint and complete."""
    con = db["con"]
    con.execute("CREATE TABLE big AS SELECT CASE WHEN i % 5 = 0 THEN 'hot' WHEN i % 7 = 0 THEN NULL ELSE 'k' || (i * i) END AS k, i FROM range(3000) r(i)")
    begins = [r[0] for r in con.execute(dialects.depth_sql("postgresql", "SELECT * FROM big;", "k", 6)).fetchall()]
    conditions = dialects.slice_conditions("postgresql", "k", begins)
    found = [con.execute(f"SELECT i FROM big WHERE {c}").fetchall() for c in conditions]
    assert len(conditions) >= 5 and sorted(sum(found, [])) == [(i,) for i in range(3000)]
    assert max(map(len, found)) < 600 + 3000 // 6 * 1.5
    assert dialects.slice_conditions("mysql", "k", []) == dialects.slice_conditions("mysql", "k", ["a", "a"]) == ["1 = 1"]
    want = ["(`k` < 'b''' OR `k` IS NULL)", "`k` >= 'b''' AND `k` < 'c'", "`k` >= 'c'"]
    assert dialects.slice_conditions("mysql", "k", ["a", "b'", "b'", "c"]) == want


@pytest.mark.parametrize(
    ("sql", "args", "want"),
    [
        ("a = :x AND b = ':x' -- :x\n AND c = :y", {"x": 5, "y": "o'k"}, "a = 5 AND b = ':x' -- :x\n AND c = 'o''k'"),
        ("a = ? /* ? */ AND b::int = ? AND c = '?''?'", [dt.date(2024, 1, 2), None], "a = '2024-01-02' /* ? */ AND b::int = NULL AND c = '?''?'"),
        ('"a:x" = :x AND `b?` = 1', {"x": 2}, '"a:x" = 2 AND `b?` = 1'), ("a = 1", {}, "a = 1"),
    ],
)
def test_parameters_of_a_database(sql, args, want):
    assert dialects.bound("postgresql", sql, args) == want


def test_wrong_parameters_are_refused():
    for sql, args in (("a = :x", {"y": 1}), ("a = ?", [1, 2]), ("a = ? AND b = ?", [1])):
        with pytest.raises(ConfigError):
            dialects.bound("mysql", sql, args)


# ---- reads -----------------------------------------------------------------


class Reader:
    """Records options; ``load`` answers from the tables given."""

    made: list = []

    def __init__(self, answer):
        self.options, self.answer = {}, answer
        Reader.made.append(self.options)

    def option(self, k, v):
        self.options[k] = v
        return self

    def load(self):
        return self.answer(self.options)


@pytest.fixture
def reads(spark, monkeypatch):
    Reader.made = []
    source = spark.createDataFrame(
        [(1, "a", 10), (2, "b", 20), (7, "c", 30)], "id long, name string, at long"
    )

    def answer(options):
        if "query" in options:
            return source.selectExpr("min(id) AS lo", "max(id) AS hi")
        return source

    monkeypatch.setattr(jdbc, "_reader", lambda spark, conn, fetch: Reader(answer).option("fetchsize", fetch))
    return Reader.made


def test_read_in_ranges(spark, reads):
    jdbc.read_table(spark, PG, "t", ["id", "name"], "id > 3", jdbc.Slices("id", 5), fetch=77)
    bounds, read = reads[0], reads[1]
    assert bounds["query"] == 'SELECT min("id") AS "lo", max("id") AS "hi" FROM (SELECT "id", "name" FROM "t" WHERE id > 3) rt_q'
    assert read == {
        "fetchsize": 77, "dbtable": '(SELECT "id", "name" FROM "t" WHERE id > 3) rt_q', "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "7", "numPartitions": 5,
    }


def test_given_bounds_are_not_asked_for(spark, reads):
    jdbc.read_sql(spark, PG, "SELECT 1;", jdbc.Slices("id", 2, 0, 9))
    assert len(reads) == 1 and (reads[0]["lowerBound"], reads[0]["upperBound"]) == ("0", "9")
    jdbc.read_sql(spark, PG, "SELECT 1")
    assert reads[1]["numPartitions"] == 1 and "partitionColumn" not in reads[1]


@pytest.fixture
def parts(spark, reads, monkeypatch):
    made = []

    def read(spark, conn, source, conditions, fetch):
        made.append((source, list(conditions)))
        return spark.createDataFrame([(1, 10), (2, 20)], "fk long, item long")

    monkeypatch.setattr(jdbc, "_read_parts", read)
    return made


def test_few_keys_go_to_the_database(spark, reads, parts, monkeypatch):
    monkeypatch.setattr(jdbc, "KEYS_PER_LIST", 2)
    keys = spark.createDataFrame([(3,), (1,), (1,), (None,), (2,)], "k long")
    jdbc.read_for_keys(spark, PG, "items", ["fk", "item"], "fk", keys)
    source, conditions = parts[0]
    assert source == '(SELECT "fk", "item" FROM "items") rt_q' and not reads
    assert len(conditions) == 2
    listed = [c.removeprefix('"fk" IN (').removesuffix(")").split(", ") for c in conditions]
    assert sorted(sum(listed, [])) == ["1", "2", "3"]
    names = spark.createDataFrame([("o'x\\",)], "k string")
    my = Connection.parse("my", {"type": "mysql"})
    jdbc.read_for_keys(spark, my, "items", [], "fk", names)
    assert parts[1][1] == ["`fk` IN ('o''x\\\\')"]


def test_no_keys_and_many_keys(spark, reads, parts, monkeypatch):
    keys = spark.createDataFrame([(3,), (1,), (9,), (None,)], "k long")
    jdbc.read_for_keys(spark, PG, "items", [], "fk", keys.limit(0))
    assert reads[0]["dbtable"] == '(SELECT * FROM "items" WHERE 1 = 0) rt_q'
    monkeypatch.setattr(jdbc, "LISTED_KEYS", 2)
    jdbc.read_for_keys(spark, PG, "items", [], "fk", keys)
    assert reads[1]["dbtable"] == '(SELECT * FROM "items" WHERE "fk" BETWEEN 1 AND 9) rt_q'
    assert (reads[1]["lowerBound"], reads[1]["upperBound"], reads[1]["numPartitions"]) == ("1", "9", 3)
    monkeypatch.setattr(jdbc, "table_columns", lambda *a: [jdbc.ColumnInfo("id", "bigint", False, True, 1)])
    texts = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    jdbc.read_for_keys(spark, PG, "items", [], "fk", texts)
    assert reads[-1]["dbtable"] == '(SELECT * FROM "items") rt_q' and not parts
    assert reads[-1]["partitionColumn"] == "id" and reads[-1]["numPartitions"] == 3


def test_job_from_a_database(spark, reads, work):
    conns = {"pg": PG, "out": Connection.parse("out", {"type": "files", "path": work + "/out"})}
    runner = Runner(spark, Tables(spark, conns), work + "/state")
    doc = {
        "name": "j",
        "source": {"connection": "pg", "table": "t", "where": "at > ${state.m} OR name > '${env.HOME_OF_J}'", "primary_key": "id",
                   "columns": "id,name", "batch_limit": 500},
        "target": {"connection": "out", "table": "t", "primary_key": "id"},
        "sync": {"state": {"m": {"type": "max", "column": "at"}}},
    }
    with pytest.raises(Exception, match="HOME_OF_J"):
        runner.run(Job.from_dict(doc))
    doc["source"]["where"] = "at > ${state.m}"
    result = runner.run(Job.from_dict(doc), dt.datetime(2024, 1, 1))
    assert result.rows_read == 3 and result.marks["m"].value == 30
    assert reads[-1]["partitionColumn"] == "id" and reads[-1]["numPartitions"] == 3 and reads[-1]["fetchsize"] == 500
    assert reads[-1]["dbtable"] == '(SELECT "id", "name", "at" FROM "t" WHERE at > -9223372036854775808) rt_q'
    assert rows(spark.read.parquet(work + "/out/t/rt_run=u-*/*")) == [(1, "a"), (2, "b"), (7, "c")]
    runner.run(Job.from_dict(doc), dt.datetime(2024, 1, 1))
    assert reads[-1]["dbtable"].endswith("WHERE at > 30) rt_q")


def test_pages(spark, reads, work):
    from rowtide.sinks.paths import PathSink

    PathSink(spark, work + "/t").full(spark.range(10), "s")
    tables = Tables(spark, {"pg": PG, "in": Connection.parse("in", {"type": "files", "path": work})})
    tables.page("pg", "SELECT id FROM t", ["id"], 4, 2)
    assert reads[0]["dbtable"] == '(SELECT * FROM (SELECT id FROM t) rt_q ORDER BY "id" LIMIT 2 OFFSET 4) rt_q'
    assert [r[0] for r in tables.page("in", "SELECT id FROM t", ["id"], 4, 2).collect()] == [4, 5]


def test_job_into_a_database(spark, db, work):
    from rowtide.sinks.paths import PathSink

    PathSink(spark, work + "/in/src").full(spark.createDataFrame([(1, "a"), (2, "b")], "id long, a string"), "s")
    conns = {"pg": PG, "in": Connection.parse("in", {"type": "files", "path": work + "/in"})}
    runner = Runner(spark, Tables(spark, conns), work + "/state")
    doc = {"name": "j", "source": {"connection": "in", "table": "src"}, "target": {"connection": "pg", "table": "t", "primary_key": "id"}}
    for _ in range(2):
        assert runner.run(Job.from_dict(doc)).written == {"t": 2}
    assert table(db) == [(1, "a", None), (2, "b", None)]


def test_literals_of_each_product():
    from rowtide.plans.templates import Template

    marks = {
        "t": V.Constant(dt.datetime(2024, 5, 6, 7, 8, 9), T.TimestampNTZType()), "d": V.Constant(dt.date(2024, 5, 6), T.DateType()),
        "s": V.Constant("a\\b'", T.StringType()), "b": V.Constant(b"\x01\xff", T.BinaryType()),
    }
    template = Template(marks.__getitem__, dt.datetime(2024, 1, 1))
    text = "${state.t} ${state.d} ${state.s} ${state.b}"
    assert template.render(text, "oracle") == "TIMESTAMP '2024-05-06 07:08:09.000000' DATE '2024-05-06' 'a\\b''' HEXTORAW('01ff')"
    assert template.render(text, "mysql") == "'2024-05-06 07:08:09' '2024-05-06' 'a\\\\b''' X'01FF'"
    assert template.render(text, "postgresql") == "'2024-05-06 07:08:09' '2024-05-06' 'a\\b''' '\\x01ff'::bytea"


def test_full_writes_empty_their_table_inside_the_transaction():
    assert dialects.empty_sql("mysql", "t") == "DELETE FROM `t`"
    assert dialects.empty_sql("oracle", "t") == 'DELETE FROM "t"'
    assert dialects.empty_sql("postgresql", "t") == 'TRUNCATE TABLE "t"'


def test_reads_by_depth(spark, reads, parts, monkeypatch):
    source = spark.createDataFrame([("a",), ("m",), ("t",)], "rt_begin string")
    monkeypatch.setattr(jdbc, "_reader", lambda spark, conn, fetch: Reader(lambda options: source))
    jdbc.read_table(spark, PG, "t", ["name"], None, jdbc.Slices("name", 3, depth=True))
    assert "ntile(3) OVER" in Reader.made[-1]["query"]
    conditions = ["(\"name\" < 'm' OR \"name\" IS NULL)", "\"name\" >= 'm' AND \"name\" < 't'", "\"name\" >= 't'"]
    assert parts[0] == ('(SELECT "name" FROM "t") rt_q', conditions)
