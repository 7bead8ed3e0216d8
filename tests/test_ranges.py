"""Cuts, slices and deep pages by columns of any type."""

from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import functions as F

from rowtide.errors import ConfigError
from rowtide.operators import ranges
from rowtide.sources import tables as X

KINDS = {
    "string": "concat(repeat('k', id % 3), id, 'é')", "double": "CASE WHEN id % 50 = 0 THEN double('NaN') WHEN id % 51 = 0 THEN -double('Infinity') ELSE id / 7 END",
    "timestamp": "timestamp_micros(id * 86400000001)", "decimal(20,3)": "id * 1.125", "date": "date_add(DATE'1900-01-01', CAST(id AS INT))", "binary": "unhex(hex(id))", "boolean": "id % 2 = 0",
}


def wide(spark, kind, n=3000):
    """One column of the kind with nulls and repeated values, and a number."""
    value = f"CASE WHEN id % 37 = 0 THEN NULL ELSE CAST({KINDS[kind]} AS {kind}) END"
    df = spark.range(n).selectExpr(f"{value} AS k", "CAST(pmod(hash(id), 20) AS INT) AS m", "id")
    return df.unionAll(df.where("id < 40")).repartition(7)


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_slices_are_disjoint_complete_and_even(spark, kind):
    df = wide(spark, kind)
    parts = ranges.slices(df, "k", 8)
    counts = [p.count() for p in parts]
    united = parts[0]
    for p in parts[1:]:
        united = united.unionAll(p)
    assert rows(united.withColumn("k", F.col("k").cast("string"))) == rows(df.withColumn("k", F.col("k").cast("string")))
    if kind != "boolean":
        assert len(parts) == 8 and max(counts) < 2.2 * df.count() / 8


def test_slices_under_skew_and_in_little(spark):
    """Most rows in a corner of the range, one value with a third of all; the condition reaches the scan."""
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id < 8990 THEN id ELSE id * 1000000000 END AS k")
    parts = ranges.slices(df, "k", 10)
    counts = [p.count() for p in parts]
    assert sum(counts) == 9000 and len(parts) >= 6 and sorted(counts)[-2] < 2.2 * 900 and max(counts) < 3000 + 2.2 * 900
    assert len(ranges.slices(df.limit(0), "k", 5)) == len(ranges.slices(df.where("k = 7"), "k", 5)) == len(ranges.slices(df, "k", 1)) == 1
    for wrong in (("k", 0), ("nope", 2)):
        with pytest.raises(ConfigError):
            ranges.slices(df, *wrong)


def test_slices_reach_the_scan(spark, work):
    spark.range(4000).selectExpr("concat('k', lpad(id, 6, '0')) AS k", "id").write.parquet(work + "/t")
    part = ranges.slices(spark.read.parquet(work + "/t"), "k", 4)[1]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,k00" in plan and "LessThan(k,k00" in plan


@pytest.mark.parametrize("kind", sorted(KINDS))
@pytest.mark.parametrize(("offset", "limit"), [(0, 30), (1500, 400), (2980, 500), (37, 2900), (9999, 5)])
def test_deep_pages(spark, monkeypatch, kind, offset, limit):
    """Pages by ranges are those of a full sort, with nulls first and NaN last."""
    monkeypatch.setattr(X, "DEEP_PAGE", 0)
    monkeypatch.setattr(ranges, "SORTED_ROWS", 300)
    monkeypatch.setattr(ranges, "PAGE_RANGES", 16)
    df = wide(spark, kind)
    got = X.page(df, ["k", "m"], offset, limit)
    want = df.orderBy("k", "m", "id").offset(offset).limit(limit)
    text = lambda x: [tuple(r) for r in x.select(F.col("k").cast("string"), "m", "id").collect()]
    assert text(got) == text(want)


def test_pages_of_copies(spark, monkeypatch):
    """Rows that hardly differ: ranges cannot be cut further."""
    monkeypatch.setattr(ranges, "SORTED_ROWS", 50)
    monkeypatch.setattr(ranges, "SAMPLED", 1)
    monkeypatch.setattr(ranges, "PAGE_RANGES", 4)
    df = spark.range(5000).selectExpr("CASE WHEN id = 3 THEN 'a' WHEN id = 4 THEN 'z' WHEN id = 5 THEN NULL ELSE 'm' END AS k")
    for offset, limit in ((0, 3), (1, 4998), (4998, 10), (2, 40)):
        got = ranges.window(df, ["k"], offset, limit).orderBy("k")
        assert rows(got) == rows(df.orderBy("k").offset(offset).limit(limit))


def test_deep_pages_keep_no_large_heap(spark, monkeypatch):
    monkeypatch.setattr(ranges, "SORTED_ROWS", 100)
    plan = X.page(wide(spark, "string", 200_000), ["k"], 150_000, 50)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject(limit=15" not in plan and "GlobalLimit 15" not in plan
