"""Whole jobs over folders of files: writes, marks, failures, streams."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from frames import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import Connection, Job, RowStep, Runner, Tables, register_step
from rowtide import types as V
from rowtide.errors import ConfigError, RowtideError, StateError, TemplateError
from rowtide.operators.watermark import read_marks
from rowtide.plans.state import StateStore, decode, encode
from rowtide.sinks import paths as P
from rowtide.sources.storage import Storage
from rowtide.streaming import microbatch

NOW = dt.datetime(2024, 1, 31)


def frame(spark, data, schema="id long, a string, b string"):
    return spark.createDataFrame(data, schema)


# ---- path targets ----------------------------------------------------------


def test_full(spark, work):
    sink = P.PathSink(spark, work + "/t")
    assert sink.full(frame(spark, [(1, "a", "b"), (2, "c", "d")]), "r1") == 2
    assert sink.full(frame(spark, [(3, "e", "f")]), "r2") == 1
    assert rows(P.read_target(spark, work + "/t")) == [(3, "e", "f")]
    assert sink.full(frame(spark, []), "r3") == 0
    assert P.read_target(spark, work + "/t").columns == ["id", "a", "b"] and rows(P.read_target(spark, work + "/t")) == []


def test_full_from_itself(spark, work):
    sink = P.PathSink(spark, work + "/t")
    sink.full(frame(spark, [(1, "a", "b"), (2, "c", "d")]), "r1")
    sink.full(P.read_target(spark, work + "/t").where("id = 2"), "r1")
    assert rows(P.read_target(spark, work + "/t")) == [(2, "c", "d")]


def test_append_is_done_once_per_run(spark, work):
    sink = P.PathSink(spark, work + "/t")
    assert sink.append(frame(spark, [(1, "a", "b")]), "r1") == 1
    assert sink.append(frame(spark, [(1, "a")], "id int, a string"), "r2") == 1
    assert rows(P.read_target(spark, work + "/t")) == [(1, "a", None), (1, "a", "b")]
    # The repeated run counts, not the one before it.
    assert sink.append(frame(spark, [(1, "a", "b")]), "r2") == 1
    assert rows(P.read_target(spark, work + "/t")) == [(1, "a", "b"), (1, "a", "b")]
    with pytest.raises(ConfigError):
        sink.append(frame(spark, [(1, 2)], "id long, zz long"), "r3")


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_upsert(spark, work, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        sink = P.PathSink(spark, work + "/t", ("id",), ("a",))
        assert sink.upsert(frame(spark, [(1, "a", "x"), (1, "b", "y"), (2, "c", "z")]), "r1") == 2
        assert rows(P.read_target(spark, work + "/t")) == [(1, "b", "y"), (2, "c", "z")]
        batch = frame(spark, [(2, None), (3, "n"), (3, "m")], "id long, a string")
        for run in ("r2", "r2", "r3"):
            assert sink.upsert(batch, run) == 2
            assert rows(P.read_target(spark, work + "/t")) == [(1, "b", "y"), (2, None, "z"), (3, "n", None)]
        assert sink.upsert(batch.limit(0), "r4") == 0
        assert P.read_target(spark, work + "/t").count() == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    with pytest.raises(ConfigError):
        P.PathSink(spark, work + "/u").upsert(frame(spark, []), "r1")


def test_appends_are_replaced_by_their_repetition(spark, work):
    sink = P.PathSink(spark, work + "/t", ("id",))
    for run in ("2024-01", "01", "01", "2024-01"):
        assert sink.append(frame(spark, [(1, run, "b"), (2, run, "b"), (3, run, "b")]), run) == 3
    assert P.read_target(spark, work + "/t").count() == 6
    sink.upsert(frame(spark, [(9, "u", "u")]), "u1")
    assert sink.append(frame(spark, [(1, "x", "b")] * 3), "2024-01") == 3
    assert P.read_target(spark, work + "/t").count() == 7
    # An upsert and an append with one id are different runs; a repeated append may be empty.
    sink.upsert(frame(spark, [(10, "v", "v")]), "01")
    assert sink.append(frame(spark, []), "01") == 0
    assert rows(P.read_target(spark, work + "/t")) == [(1, "x", "b")] * 3 + [(10, "v", "v"), (9, "u", "u")]


def test_upserts_refuse_null_keys(spark, work):
    sink = P.PathSink(spark, work + "/t", ("id",))
    sink.upsert(frame(spark, [(1, "a", "b")]), "r1")
    with pytest.raises(Exception, match="needs values in its key columns"):
        sink.upsert(frame(spark, [(None, "a", "b"), (2, "c", "d")]), "r2")
    assert rows(P.read_target(spark, work + "/t")) == [(1, "a", "b")]


def test_a_failed_write_changes_nothing(spark, work):
    sink = P.PathSink(spark, work + "/t", ("id",))
    sink.upsert(frame(spark, [(1, "a", "b")]), "r1")
    broken = frame(spark, [(2, "x", "y")]).withColumn("a", F.raise_error(F.lit("lost")).cast("string"))
    for mode in ("full", "append", "upsert"):
        with pytest.raises(Exception, match="lost"):
            sink.write(broken, mode, "r2")
    assert rows(P.read_target(spark, work + "/t")) == [(1, "a", "b")]
    sink.vacuum(keep_hours=0)
    assert Storage(spark).list(work + "/t/_pending") == []
    assert rows(P.read_target(spark, work + "/t")) == [(1, "a", "b")]
    with pytest.raises(ConfigError):
        sink.write(broken, "merge", "r3")


@pytest.mark.parametrize("mode", ["full", "append", "upsert"])
@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_write_that_died_while_moving_is_finished(spark, work, monkeypatch, mode, moves):
    """Whatever was moved already: the next reader or writer moves the rest."""
    sink = P.PathSink(spark, work + "/t", ("id",), buckets=4)
    sink.append(frame(spark, [(i, "a", "b") for i in range(9)]), "r1")
    real, done = Storage.replace_dir, []

    def dying(self, made, path):
        if len(done) >= moves:
            raise RuntimeError("killed")
        done.append(path)
        real(self, made, path)

    monkeypatch.setattr(Storage, "replace_dir", dying)
    batch = frame(spark, [(i, "new", "n") for i in range(5, 12)])
    try:
        sink.write(batch, mode, "r2")
    except RuntimeError:
        pass
    monkeypatch.setattr(Storage, "replace_dir", real)
    old = [] if mode == "full" else [(i, "a", "b") for i in range(9 if mode == "append" else 5)]
    want = sorted(old + [(i, "new", "n") for i in range(5, 12)], key=str)
    assert sorted(rows(P.read_target(spark, work + "/t")), key=str) == want
    assert sorted(rows(P.read_target(spark, work + "/t")), key=str) == want


def test_concurrent_writes_are_refused(spark, work):
    """Of two writers that began with the same state, the second fails and changes nothing."""
    one, two = (P.PathSink(spark, work + "/t", ("id",)) for _ in range(2))
    one.full(frame(spark, [(1, "a", "b")]), "r1")
    before = two.opened()
    one.append(frame(spark, [(2, "a", "b")]), "r2")
    with pytest.raises(RowtideError, match="meanwhile"):
        two._put(before, before, two._dealt(frame(spark, [(3, "c", "d")]), before, "a-r3"), run="a-r3")
    assert rows(P.read_target(spark, work + "/t")) == [(1, "a", "b"), (2, "a", "b")]
    claimed = {"folder": "elsewhere", "whole": False, "run": "a-r4", "runs": ["rt_run=a-r4"], "layout": before.text()}
    Storage(spark).create_text(work + "/t/_STEP", json.dumps(claimed))
    with pytest.raises(RowtideError, match="another run"):
        two._put(before, before, two._dealt(frame(spark, [(3, "c", "d")]), before, "a-r3"), run="a-r3")
    with pytest.raises(RowtideError):
        P.read_target(spark, work + "/nothing")
    with pytest.raises(ConfigError, match="RT_RUN"):
        one.full(frame(spark, [(1, "a", "b")]).withColumn("RT_RUN", F.lit(1)), "r5")


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_upserts_touch_only_buckets_of_their_batch(spark, work, threshold):
    """Five rows leave the files of all other buckets as they were, also after appends."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        sink = P.PathSink(spark, work + "/t", ("id",), buckets=40)
        sink.append(frame(spark, [(i, "a", "x") for i in range(600)] + [(None, f"n{i}", "n") for i in range(50)]), "r1")
        sink.append(frame(spark, [(i, "b", "y") for i in range(590, 900)]), "r2")
        want = {("a", "x", i) for i in range(600)} | {("b", "y", i) for i in range(590, 900)} | {(f"n{i}", "n", None) for i in range(50)}
        for run, ids in (("r3", range(5)), ("r4", (595, 7, 2000, 899, 3)), ("r4", (595, 7, 2000, 899, 3))):
            before = P.partitions(spark, work + "/t")
            assert sink.upsert(spark.createDataFrame([(i, run) for i in ids], "id long, a string"), run) == 5
            after = P.partitions(spark, work + "/t")
            changed = {p.split("/")[1] for p in {*before, *after} if before.get(p) != after.get(p)}
            assert 1 <= len(changed) <= 5
            want = {(run if i in ids else a, b, i) for a, b, i in want}
            want |= {(run, None, i) for i in ids if i not in {w[2] for w in want}}
            got = [(r["a"], r["b"], r["id"]) for r in P.read_target(spark, work + "/t").collect()]
            assert len(got) == len(want) and set(got) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_upserts_read_only_touched_partitions(spark, work):
    sink = P.PathSink(spark, work + "/t", ("id",), buckets=40)
    sink.append(frame(spark, [(i, "a", "x") for i in range(600)]), "r1")
    target = sink.rows(sink.opened()).where(F.col(P.BUCKET).isin([3, 4]))
    assert len(target.inputFiles()) == 40
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [rt_bucket" in plan


def test_upsert_by_other_keys_deals_the_target_anew(spark, work):
    P.PathSink(spark, work + "/t", ("id",)).append(frame(spark, [(i, f"k{i}", "x") for i in range(30)]), "r1")
    by_a = P.PathSink(spark, work + "/t", ("a",))
    assert by_a.upsert(frame(spark, [("k3", "y"), ("new", "z")], "a string, b string"), "r2") == 2
    want = [(i, f"k{i}", "y" if i == 3 else "x") for i in range(30)] + [(None, "new", "z")]
    assert sorted(rows(P.read_target(spark, work + "/t")), key=str) == sorted(want, key=str)
    assert by_a.opened().keys == ("a",)
    # A key of another type is hashed as the target has it.
    assert by_a.upsert(spark.createDataFrame([("k5", 7)], "a string, id int"), "r3") == 1
    P.PathSink(spark, work + "/t", ("id",)).upsert(spark.createDataFrame([(7, "seven")], "id int, b string"), "r4")
    assert {tuple(r) for r in P.read_target(spark, work + "/t").where("id = 7").collect()} == {(7, "k5", "seven"), (7, "k7", "seven")}


@pytest.mark.parametrize("key", ["string", "timestamp", "date", "decimal(10,2)", "double", "boolean"])
def test_upserts_by_any_key_type(spark, work, key):
    values = {
        "string": ["a", "b'", ""], "timestamp": ["2024-01-01 05:06:07.123456", "2024-01-02", "2023-12-31"],
        "date": ["2024-01-01", "2024-01-02", "2023-12-31"], "decimal(10,2)": ["1.50", "-2.25", "9"],
        "double": ["0.1", "1e300", "-5"], "boolean": ["true", "false"],
    }[key]
    df = spark.createDataFrame([(v, "old") for v in values], "k string, a string").withColumn("k", F.col("k").cast(key))
    sink = P.PathSink(spark, work + "/t", ("k",))
    sink.upsert(df, "r1")
    sink.upsert(df.where("k IS NOT NULL").limit(2).withColumn("a", F.lit("new")), "r2")
    out = [r["a"] for r in P.read_target(spark, work + "/t").collect()]
    assert sorted(out) == ["new", "new", "old"][: len(values)]


# ---- state -----------------------------------------------------------------


def test_state(spark, work):
    store = StateStore(spark, work, "job one/é")
    assert store.load() == {}
    store.commit({"id": V.Constant(5, T.LongType()), "t": V.Constant("b", T.StringType())}, "r1")
    store.commit({"id": V.Constant(3, T.LongType()), "t": V.Constant(None, T.StringType())}, "r2")
    assert {k: c.value for k, c in store.load().items()} == {"id": 5, "t": "b"}
    store.commit({"id": V.Constant(7, T.LongType())}, "r3")
    assert store.load()["id"] == V.Constant(7, T.LongType())
    for i in range(30):
        store.commit({"id": V.Constant(10 + i, T.LongType())}, f"x{i}")
    assert store.load()["id"].value == 39 and len(Storage(spark).list(store.folder)) <= 22
    with pytest.raises(StateError):
        StateStore(spark, work, "job one/?").load()
    store.reset()
    assert store.load() == {}


def test_of_two_commits_at_once_one_fails(spark, work, monkeypatch):
    one, two = StateStore(spark, work, "j"), StateStore(spark, work, "j")
    one.commit({"id": V.Constant(1, T.LongType())}, "r1")
    real = StateStore.load

    def meanwhile(self):
        marks = real(self)
        monkeypatch.setattr(StateStore, "load", real)
        one.commit({"id": V.Constant(9, T.LongType())}, "r2")
        return marks

    monkeypatch.setattr(StateStore, "load", meanwhile)
    with pytest.raises(StateError, match="another run"):
        two.commit({"id": V.Constant(5, T.LongType())}, "r3")
    assert two.load()["id"].value == 9 and len(Storage(spark).list(two.folder)) == 2


def test_marks_are_instants(spark, work):
    """When clocks are set back, one local time is two instants: the mark is the later one that was read."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        P.PathSink(spark, f"{work}/in/src").full(
            spark.sql("SELECT id, timestamp_micros(1730613600000000 + id * 1800000000L) AS at FROM range(6)"), "s"
        )
        doc = {"name": "dst", "sync": {"mode": "append", "state": {"m": {"type": "max", "column": "at"}}},
               "source": {"connection": "in", "table": "src", "where": "at > ${state.m}", "columns": "id,at"},
               "target": {"connection": "out", "table": "dst"}}
        files = {n: Connection.parse(n, {"type": "files", "path": f"{work}/{n}"}) for n in ("in", "out")}
        runner, job = Runner(spark, Tables(spark, files), f"{work}/state"), Job.from_dict(doc)
        for last in (2, 3, 4, 5):
            seen = spark.sql(f"SELECT timestamp_micros(1730613600000000 + {last} * 1800000000L) AS at")
            store = runner.store(job)
            store.reset()
            _, marks = read_marks(seen, {"m": "at"})
            store.commit(marks, "r")
            assert runner.read(job, dt.datetime(2024, 11, 4), store.load()).count() == 5 - last
        # A mark that an earlier release kept in local time is still understood.
        assert StateStore(spark, work, "x")._instant(V.Constant(dt.datetime(2024, 11, 2, 12), T.TimestampType())).value.timestamp() == 1730563200
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("mode", ["upsert", "append", "full"])
@pytest.mark.parametrize("tables", [1, 3])
def test_steps_run_once(spark, work, mode, tables):
    """However many tables there are, and also for the count of rows after the steps."""
    counter = spark.sparkContext.accumulator(0)
    names = ["", "b", "c"][:tables]

    def twice(row):
        counter.add(1)
        for name in names:
            yield from [(name, row)] * 2

    schema = T._parse_datatype_string("id bigint, u string")
    register_step("twice_each")(lambda config: RowStep(twice, {name: schema for name in names}))
    P.PathSink(spark, f"{work}/in/src").full(spark.range(50).selectExpr("id % 20 AS id", "uuid() AS u"), "s")
    doc = {"name": "once", "sync": {"mode": mode}, "etl": [{"plugin": "twice_each"}],
           "source": {"connection": "in", "table": "src", "columns": "id,u", "primary_key": "id"},
           "target": {"connection": "out", "table": "dst", "columns": "id,u", "primary_key": "id", "keys": {"b": ["id"], "c": ["id"]}}}
    files = {n: Connection.parse(n, {"type": "files", "path": f"{work}/{n}"}) for n in ("in", "out")}
    result = Runner(spark, Tables(spark, files), f"{work}/state").run(Job.from_dict(doc))
    assert (result.rows_read, result.rows_out) == (50, 100 * tables)
    assert result.written == {name or "dst": 20 if mode == "upsert" else 100 for name in names}
    assert counter.value == 50


@pytest.mark.parametrize(
    ("value", "dtype"),
    [
        (2**62 + 1, "bigint"), (1.1, "double"), ("é'", "string"), (dt.date(2024, 1, 2), "date"),
        (dt.datetime(2024, 1, 2, 3, 4, 5, 6), "timestamp_ntz"), (dt.datetime(2024, 1, 2), "timestamp"),
        (__import__("decimal").Decimal("10.50"), "decimal(10,2)"),
    ],
)
def test_marks_keep_their_type(value, dtype):
    dtype = T._parse_datatype_string(dtype)
    assert decode(encode(value, dtype)) == V.Constant(value, dtype)


def test_decimal_marks_compare_as_numbers(spark, work):
    store, d = StateStore(spark, work, "d"), T.DecimalType(10, 2)
    from decimal import Decimal

    store.commit({"m": V.Constant(Decimal("9.50"), d)}, "r1")
    store.commit({"m": V.Constant(Decimal("10.50"), d)}, "r2")
    assert store.load()["m"].value == Decimal("10.50")


# ---- jobs ------------------------------------------------------------------


def runner(spark, work):
    conns = {n: Connection.parse(n, {"type": "files", "path": f"{work}/{n}"}) for n in ("in", "out")}
    return Runner(spark, Tables(spark, conns), f"{work}/state", retry=0)


def job(**change):
    doc = {
        "name": "sync",
        "source": {"connection": "in", "table": "src", "where": "t > ${state.m}", "primary_key": "id",
                   "columns": "id,a"},
        "target": {"connection": "out", "table": "dst", "columns": "id,name", "primary_key": "id"},
        "sync": {"mode": "upsert", "state": {"m": {"type": "max", "column": "t"}}},
    }
    return Job.from_dict({**doc, **change})


def put(spark, work, data, schema="id long, a string, t timestamp", name="src"):
    P.PathSink(spark, f"{work}/in/{name}").full(frame(spark, [], schema).unionByName(
        spark.createDataFrame([r[:-1] + (str(r[-1]),) for r in data], schema.replace("t timestamp", "t string"))
        .withColumn("t", F.col("t").cast("timestamp"))
    ) if "t timestamp" in schema else frame(spark, data, schema), "seed")


def test_two_runs(spark, work):
    run = runner(spark, work)
    put(spark, work, [(1, "a", "2024-01-01 05:00:00"), (2, "b", "2024-01-02 06:00:00")])
    one = run.run(job(), NOW)
    assert one.rows_read == 2 and one.written == {"dst": 2}
    # The session's clock, not the one of the Python process.
    assert one.marks["m"].value == dt.datetime(2024, 1, 2, 6, tzinfo=dt.UTC)
    put(spark, work, [(1, "z", "2024-01-01 05:00:00"), (2, "B", "2024-01-03 00:00:00"), (3, "c", "2024-01-04 00:00:00")])
    two = run.run(job(), NOW)
    assert two.rows_read == 2 and "source rows   2" in two.summary() and "into " in two.summary()
    assert rows(P.read_target(spark, f"{work}/out/dst")) == [(1, "a"), (2, "B"), (3, "c")]
    three = run.run(job(), NOW)
    assert (three.rows_read, three.written) == (0, {"dst": 0})
    assert three.marks == two.marks and "source rows   0" in three.summary()
    run.reset_state(job())
    assert run.run(job(), NOW).rows_read == 3


def test_a_failed_run_keeps_the_mark(spark, work):
    run = runner(spark, work)
    put(spark, work, [(1, "5", "2024-01-01 00:00:00"), (2, "x", "2024-01-02 00:00:00")])
    bad = job(etl=[{"cast": {"column": [{"name": "name", "type": "int"}]}}])
    with pytest.raises(Exception, match="cannot cast 'x' to int"):
        run.run(bad, NOW)
    assert run.store(bad).load() == {}
    assert run.run(job(), NOW).rows_read == 2


def test_last_row_of_a_key_wins(spark, work):
    put(spark, work, [(1, "new", "2024-01-02 00:00:00"), (1, "old", "2024-01-01 00:00:00")])
    same = job(source={"connection": "in", "table": "src"}, target={"connection": "out", "table": "dst", "primary_key": ["id"]})
    runner(spark, work).run(same, NOW)
    assert [r[1] for r in rows(P.read_target(spark, f"{work}/out/dst"))] == ["new"]


@pytest.mark.parametrize("mode", ["full", "append"])
def test_other_modes(spark, work, mode):
    run = runner(spark, work)
    put(spark, work, [(1, "a", "2024-01-01 00:00:00")])
    doc = job(sync={"mode": mode}, source={"connection": "in", "table": "src", "columns": "id,a"})
    run.run(doc, NOW)
    run.run(doc, NOW)
    assert len(rows(P.read_target(spark, f"{work}/out/dst"))) == (1 if mode == "full" else 2)


def test_custom_select(spark, work):
    run = runner(spark, work)
    put(spark, work, [(1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-02 00:00:00")])
    put(spark, work, [(1, "x")], "sid long, note string", "notes")
    doc = job(
        source={"connection": "in", "select": "SELECT id, concat(a, coalesce(note, '')) AS a, t FROM src "
                "LEFT JOIN notes ON id = sid WHERE t > ${state.m};", "columns": "id,a"},
    )
    with pytest.raises(ConfigError, match="no column|needs"):
        run.run(job(source={"connection": "in", "select": "SELECT id FROM src"}), NOW)
    assert run.run(doc, NOW).rows_read == 2
    assert rows(P.read_target(spark, f"{work}/out/dst")) == [(1, "ax"), (2, "b")]
    assert run.run(doc, NOW).rows_read == 0


def test_selects_side_by_side_see_their_own_tables(spark, work):
    from concurrent.futures import ThreadPoolExecutor

    for name, n in (("in", 3), ("out", 5)):
        P.PathSink(spark, f"{work}/{name}/things").full(spark.range(n), "s")
    tables = runner(spark, work).connections
    spark.range(7).createOrReplaceTempView("things")

    def count(name):
        return tables.select(name, "SELECT count(*) FROM things").first()[0]

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(count, ["in", "out"] * 6)) == [3, 5] * 6
    assert spark.table("things").count() == 7
    spark.catalog.dropTempView("things")
    assert count("in") == 3 and not spark.catalog.tableExists("things")


def test_split_job(spark, work):
    run = runner(spark, work)
    put(spark, work, [(1, 10, 5.0), (2, 20, -1.0), (3, 30, 7.0)], "oid long, uid long, amount double", "orders")
    put(spark, work, [(1, 100, 2), (1, 101, 3), (2, 102, 4), (9, 103, 5)], "fk long, item long, qty long", "items")
    doc = job(
        source={"connection": "in", "table": "orders", "primary_key": ["oid"]},
        target={"connection": "out", "table": "order", "primary_key": ["oid"], "keys": {"order_item": ["item"]}},
        sync={},
        etl=[
            {"filter": {"keep": "amount gte 0"}},
            {"plugin": "order_split", "config": {
                "detail_table": "order_item", "source_detail_table": "items", "detail_columns": ["item", "qty"],
                "parent_key": "oid", "child_key": "fk", "keep": ["oid", "uid"]}},
            {"set": {"constant": {"origin": "till"}}},
        ],
    )
    for _ in range(2):
        assert run.run(doc, NOW).written == {"order": 2, "order_item": 2}
    assert rows(P.read_target(spark, f"{work}/out/order")) == [(1, 10, "till"), (3, 30, "till")]
    assert rows(P.read_target(spark, f"{work}/out/order_item")) == [(100, 2), (101, 3)]
    keyless = job(source=dict(connection="in", table="orders"), target={"connection": "out", "table": "order", "primary_key": "oid"},
                  sync={}, etl=[{"order_split": {"detail_table": "items", "parent_key": "oid", "child_key": "fk"}}])
    with pytest.raises(ConfigError, match="upsert needs keys"):
        run.run(keyless, NOW)


def test_conditions_may_hold_braces(spark, work):
    put(spark, work, [(1, "{x}", "2024-01-01 00:00:00"), (2, "y", "2024-01-02 00:00:00")])
    doc = job(source={"connection": "in", "table": "src", "where": "t > ${state.m} AND a LIKE '{%}'", "columns": "id,a"})
    assert runner(spark, work).run(doc, NOW).rows_read == 1


def test_undeclared_state_and_unknown_connection(spark, work):
    run = runner(spark, work)
    put(spark, work, [(1, "a", "2024-01-01 00:00:00")])
    with pytest.raises(TemplateError):
        run.run(job(sync={}), NOW)
    with pytest.raises(ConfigError):
        run.run(job(source={"connection": "nope", "table": "src"}), NOW)


def test_schema(spark, work):
    put(spark, work, [(1, "a", "2024-01-01 00:00:00")])
    columns = runner(spark, work).connections.schema("in", "src")
    assert [(c.name, c.data_type, c.ordinal) for c in columns] == [("id", "bigint", 1), ("a", "string", 2), ("t", "timestamp", 3)]


def test_row_step_runs_once_for_several_tables(spark, work):
    from rowtide import RowStep, register_step

    ran = spark.sparkContext.accumulator(0)

    def fn(row):
        ran.add(1)
        yield "", {"id": row["id"]}
        yield "log", {"id": row["id"], "note": "seen"}

    tables = {"": T._parse_datatype_string("id bigint"), "log": T._parse_datatype_string("id bigint, note string")}
    register_step("twice")(lambda config: RowStep(fn, tables))
    put(spark, work, [(1, "a"), (2, "b")], "id long, a string")
    doc = job(
        source={"connection": "in", "table": "src"},
        target={"connection": "out", "table": "dst", "primary_key": "id", "keys": {"log": "id"}},
        sync={}, etl=["twice"],
    )
    assert runner(spark, work).run(doc, NOW).written == {"dst": 2, "log": 2}
    assert ran.value == 2
    assert rows(P.read_target(spark, f"{work}/out/log")) == [(1, "seen"), (2, "seen")]
    left = Storage(spark).list(spark.conf.get("spark.checkpoint.dir") + "/rowtide")
    assert not [n for n in left if n.startswith("stage-")]


# ---- streams ---------------------------------------------------------------


def test_stream(spark, work):
    run = runner(spark, work)
    schema = "id long, a string, t timestamp_ntz"
    doc = job(source={"connection": "in", "table": "src", "columns": "id,a"})

    def arrive(data):
        df = spark.createDataFrame(data, "id long, a string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(work + "/stream")

    def go():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(work + "/stream")
        microbatch.start(run, doc, stream, work + "/check").awaitTermination()

    arrive([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")])
    arrive([(2, "c", "2024-01-03")])
    go()
    assert rows(P.read_target(spark, f"{work}/out/dst")) == [(1, "a"), (2, "c")]
    arrive([(3, "d", "2024-01-04"), (1, "e", "2024-01-05")])
    go()
    assert rows(P.read_target(spark, f"{work}/out/dst")) == [(1, "e"), (2, "c"), (3, "d")]
    assert run.store(doc).load()["m"].value == dt.datetime(2024, 1, 5)
    with pytest.raises(ConfigError):
        microbatch.start(run, job(sync={"mode": "full"}), None, work)


def test_two_streams_into_one_target(spark, work):
    """Both start at batch zero; neither may be taken for a repetition of the other."""
    run = runner(spark, work)
    doc = job(sync={"mode": "append"}, source={"connection": "in", "table": "src", "columns": "id,a"})
    for name in ("one", "two"):
        spark.createDataFrame([(1, name)], "id long, a string").write.parquet(f"{work}/{name}")
        for _ in range(2):
            stream = spark.readStream.schema("id long, a string").parquet(f"{work}/{name}")
            microbatch.start(run, doc, stream, f"{work}/check-{name}").awaitTermination()
    assert rows(P.read_target(spark, f"{work}/out/dst")) == [(1, "one"), (1, "two")]


def test_poll(spark, work):
    import time

    run, seen = runner(spark, work), []
    put(spark, work, [(1, "a", "2024-01-01 00:00:00")])
    query = microbatch.poll(run, job(), work + "/check", "1 second", seen.append)
    try:
        deadline = time.monotonic() + 120
        while not any(r.rows_read for r in seen) and time.monotonic() < deadline:
            time.sleep(0.2)
        put(spark, work, [(1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-02 00:00:00")])
        while sum(r.rows_read for r in seen) < 2 and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        query.stop()
    assert [r.rows_read for r in seen if r.rows_read] == [1, 1]
    assert rows(P.read_target(spark, f"{work}/out/dst")) == [(1, "a"), (2, "b")]


def test_the_clock_follows_the_session(spark):
    from rowtide.plans.runner import session_now

    here = session_now(spark)
    assert here.utcoffset() == dt.timedelta(0)
    assert abs(here - dt.datetime.now(dt.timezone.utc)) < dt.timedelta(minutes=1)
    assert f"{here:%z}" == "+0000"


def test_repeated_micro_batch_appends_once(spark, work):
    run = runner(spark, work)
    doc = job(sync={"mode": "append"}, source={"connection": "in", "table": "src", "columns": "id,a"})
    batch = frame(spark, [(1, "a", None)])
    for _ in range(2):
        run.write(doc, run.plan(doc, batch), "batch000000000001")
    assert rows(P.read_target(spark, f"{work}/out/dst")) == [(1, "a")]


def test_late_rows_pass_once_inside_the_bound(spark, work):
    """Repeated keys of later micro-batches are dropped, late rows kept; beyond the bound rows are lost."""
    job = Job.from_dict({"name": "late", "source": {"connection": "out", "table": "e", "primary_key": "id"},
                         "target": {"connection": "out", "table": "once"}, "sync": {"mode": "append"}})
    runner = Runner(spark, Tables(spark, {"out": Connection.parse("out", {"type": "files", "path": f"{work}/out"})}), f"{work}/state")
    late = microbatch.Lateness("t", "1 hour")
    batches = [
        [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 11:30:00"), (2, "2024-01-01 11:30:00")],
        [(2, "2024-01-01 11:30:00"), (3, "2024-01-01 10:45:00"), (4, "2024-01-01 13:00:00"), (9, "2024-01-01 09:00:00")],
        [(4, "2024-01-01 13:00:00"), (3, "2024-01-01 12:30:00"), (5, "2024-01-01 12:01:00")],
    ]
    schema = "id long, t timestamp"
    for data in batches:
        spark.createDataFrame(data, "id long, t string").selectExpr("id", "CAST(t AS timestamp) AS t").write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(schema).parquet(f"{work}/in")
        microbatch.start(runner, job, stream, f"{work}/checkpoint", late=late).awaitTermination()
    got = sorted((r["id"], r["t"].strftime("%H:%M")) for r in P.read_target(spark, f"{work}/out/once").withColumn("t", F.col("t").cast("timestamp_ntz")).collect())
    # Key 3 comes again after its state is over: its bound had passed.
    assert got == [(1, "10:00"), (2, "11:30"), (3, "10:45"), (3, "12:30"), (4, "13:00"), (5, "12:01")]
    with pytest.raises(ConfigError, match="key"):
        late.once(spark.readStream.schema(schema).parquet(f"{work}/in"), ())
