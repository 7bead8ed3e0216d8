"""Main documents, and targets in Spark's catalogue."""

from __future__ import annotations

import datetime as dt
import time
from pathlib import Path

import pytest
from frames import rows

from rowtide import Connection, Job, Runner, Tables, load_app
from rowtide.errors import ConfigError
from rowtide.plans.config import App
from rowtide.sinks.catalog import CatalogSink, merge_sql
from rowtide.sinks.paths import PathSink, read_target

MAIN = """
datasource_file: conf/datasource.yaml
jobs: [jobs/a.yaml, jobs/b.yaml, jobs/off.yaml]
state_dir: state
runtime: {workers: 2, retry: 1, page_size: 500}
"""

JOB = """
name: %s
enabled: %s
source: {connection: lake, table: %s}
target: {connection: lake, table: %s, primary_key: id}
schedule: {cron: "*/10 * * * * *"}
"""


def test_app(spark, work):
    root = Path(work)
    for folder in ("conf", "jobs"):
        (root / folder).mkdir()
    (root / "config.yaml").write_text(MAIN)
    (root / "conf/datasource.yaml").write_text(f"connections: {{lake: {{type: files, path: {work}/lake}}}}")
    (root / "jobs/a.yaml").write_text(JOB % ("a", "true", "src", "one"))
    (root / "jobs/b.yaml").write_text(JOB % ("b", "true", "missing", "two"))
    (root / "jobs/off.yaml").write_text(JOB % ("paused", "false", "src", "three"))
    PathSink(spark, work + "/lake/src").full(spark.range(3), "seed")
    app = load_app(spark, work + "/config.yaml")
    assert [j.name for j in app.jobs] == ["a", "b"] and app.runner.retry == 1 and app.runner.fetch == 500
    results = app.run_once()
    assert results["a"].written == {"one": 3} and isinstance(results["b"], Exception)
    assert read_target(spark, work + "/lake/one").count() == 3
    (root / "jobs/b.yaml").write_text(JOB % ("a", "true", "src", "two"))
    with pytest.raises(ConfigError, match="same name"):
        load_app(spark, work + "/config.yaml")
    (root / "config.yaml").write_text("[")
    with pytest.raises(ConfigError):
        load_app(spark, work + "/config.yaml")


def test_catalog_sink(spark, work):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    spark.sql("DROP TABLE IF EXISTS shop.people")
    spark.sql("CREATE TABLE shop.people (id BIGINT, name STRING) USING parquet")
    sink = CatalogSink(spark, "`shop`.`people`", ("id",))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "name string, id long")
    assert sink.write(df, "append", "r1") == 2
    assert sink.write(df.where("id = 1"), "append", "r2") == 1
    assert rows(spark.table("shop.people")) == [(1, "a"), (1, "a"), (2, "b")]
    # From itself, and down to nothing.
    assert sink.write(spark.table("shop.people").where("id = 2"), "full", "r3") == 1
    assert rows(spark.table("shop.people")) == [(2, "b")]
    assert sink.write(df.limit(0), "full", "r4") == 0 and spark.table("shop.people").count() == 0
    for keys, mode in (((), "upsert"), (("id",), "merge")):
        with pytest.raises(ConfigError):
            CatalogSink(spark, "shop.people", keys).write(df, mode, "r5")
    # Plain Parquet tables have no row-level changes.
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        sink.write(df, "upsert", "r6")
    spark.sql("DROP TABLE shop.people")


def test_catalog_job(spark, work):
    from rowtide import Connection, Job, Runner, Tables

    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    for name in ("src", "dst"):
        spark.sql(f"DROP TABLE IF EXISTS shop.{name}")
        spark.sql(f"CREATE TABLE shop.{name} (id BIGINT, at TIMESTAMP) USING parquet")
    spark.sql("INSERT INTO shop.src VALUES (1, TIMESTAMP '2024-01-01 05:00:00'), (2, TIMESTAMP '2024-01-02 00:00:00')")
    shop = Connection.parse("shop", {"type": "catalog", "database": "shop"})
    runner = Runner(spark, Tables(spark, {"shop": shop}), work + "/state")
    doc = {
        "name": "j", "source": {"connection": "shop", "select": "SELECT * FROM shop.src WHERE at > ${state.m}"},
        "target": {"connection": "shop", "table": "dst"},
        "sync": {"mode": "append", "state": {"m": {"type": "max", "column": "at"}}},
    }
    for want in (2, 0):
        assert runner.run(Job.from_dict(doc), dt.datetime(2024, 2, 1)).written == {"dst": want}
    assert spark.table("shop.dst").count() == 2
    assert [c.data_type for c in runner.connections.schema("shop", "src")] == ["bigint", "timestamp"]
    for name in ("src", "dst"):
        spark.sql(f"DROP TABLE shop.{name}")


def test_merge_statement():
    assert merge_sql("t", "v", ["id", "a"], ["id"]) == (
        "MERGE INTO t t USING v s ON t.`id` = s.`id` WHEN MATCHED THEN UPDATE SET t.`a` = s.`a` "
        "WHEN NOT MATCHED THEN INSERT (`id`, `a`) VALUES (s.`id`, s.`a`)"
    )
    assert "UPDATE" not in merge_sql("t", "v", ["id"], ["id"])


def test_app_polls_jobs_with_an_interval(spark, work):
    """``schedule.every`` runs a job again and again; rows that came meanwhile are found."""
    source = PathSink(spark, work + "/lake/src")
    source.append(spark.range(3), "a")
    files = {"lake": Connection.parse("lake", {"type": "files", "path": f"{work}/lake"})}
    doc = {"name": "timed", "source": {"connection": "lake", "table": "src", "where": "id > ${state.m}", "primary_key": "id", "columns": "id"},
           "target": {"connection": "lake", "table": "dst", "primary_key": "id", "columns": "id"},
           "sync": {"state": {"m": {"type": "max", "column": "id"}}}, "schedule": {"every": "1 second"}}
    jobs = (Job.from_dict(doc), Job.from_dict({**doc, "name": "untimed", "schedule": {}}))
    results = []
    started = App(Runner(spark, Tables(spark, files), work + "/state"), jobs).poll(work + "/clock", results.append)
    try:
        assert len(started) == 1
        for wanted in (3, 5):
            if wanted == 5:
                source.append(spark.range(3, 5), "b")
            end = time.monotonic() + 90
            while sum(r.rows_read for r in results) < wanted and time.monotonic() < end:
                time.sleep(0.2)
    finally:
        for q in started:
            q.stop()
    assert sorted(r[0] for r in read_target(spark, work + "/lake/dst").collect()) == [0, 1, 2, 3, 4]
