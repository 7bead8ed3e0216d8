from __future__ import annotations

import random

import pytest
from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowtide.errors import ConfigError
from rowtide.operators import lookup as L
from rowtide.operators import split as S
from rowtide.operators import upsert as U
from rowtide.operators.ranking import dedup_last, first_n, salts_for
from rowtide.operators.routing import bucket_of, fan_out, route, table_counts
from rowtide.operators.steps import StepContext, StepSpec
from rowtide.sources.tables import page


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows belongs to key 0, many of them copies of one another."""
    rng = random.Random(7)
    data = [(0 if rng.random() < 0.34 else rng.randrange(50), rng.randrange(20), rng.choice("xyz")) for _ in range(3000)]
    return data, spark.createDataFrame(data, "k long, v long, s string").repartition(6)


def brute_first(data, n):
    out = []
    for key in {r[0] for r in data}:
        out += sorted(r for r in data if r[0] == key)[:n]
    return sorted(out)


@pytest.mark.parametrize("salts", [1, 8])
@pytest.mark.parametrize("n", [1, 7, 5000])
def test_first_n(skewed, n, salts):
    data, df = skewed
    assert rows(first_n(df, ["k"], n, ["v"], salts)) == sorted(brute_first(data, n), key=lambda r: tuple((True, str(v)) for v in r))


def test_first_n_limits_before_the_shuffle(spark, work, skewed):
    skewed[1].write.parquet(work + "/t")
    plan = first_n(spark.read.parquet(work + "/t"), ["k"], 5)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_salts_grow_with_the_input(spark, work, skewed):
    skewed[1].write.parquet(work + "/t")
    df = spark.read.parquet(work + "/t")
    assert salts_for(df, 1000) == 1 and salts_for(df, 10_000) > 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        assert salts_for(df, 1000) == 1 + 1000 * (1 + sum_size(df)) // 200_000_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def sum_size(df):
    from rowtide.plans.sizing import scan_bytes

    return scan_bytes(df)


def test_dedup_last(skewed):
    data, df = skewed
    want = {}
    for r in data:
        key = (r[1], r[2])
        want[r[0]] = max(want.get(r[0], key), key)
    assert dict((r[0], (r[1], r[2])) for r in dedup_last(df, ["k"], ["v"]).collect()) == want
    assert dedup_last(df.select("k"), ["k"]).count() == 50
    with pytest.raises(ConfigError):
        dedup_last(df, [])


def test_dedup_last_nulls_lose(spark):
    df = spark.createDataFrame([(1, None), (1, 5), (2, None)], "k long, v long")
    assert rows(dedup_last(df, ["k"], ["v"])) == [(1, 5), (2, None)]


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame([(1, "a", 3), (1, "b", 1), (2, "c", 9), (None, "d", 0)], "id long, name string, w long")


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup(spark, dim, threshold):
    df = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None)], "x long, ref long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        on = {"ref": "id"}
        assert rows(L.lookup(df, dim, on, ["name"])) == [
            (10, 1, "a"), (10, 1, "b"), (11, 2, "c"), (12, 3, None), (13, None, None)
        ]
        assert rows(L.lookup(df, dim, on, ["name"], limit=1, order=["w"])) == [
            (10, 1, "b"), (11, 2, "c"), (12, 3, None), (13, None, None)
        ]
        assert rows(L.lookup(df, dim, on, ["name"], where="w > :low", params={"low": 2}, how="inner")) == [
            (10, 1, "a"), (11, 2, "c")
        ]
        assert L.lookup(df, dim, on, ["id", "name"]).columns == ["x", "ref", "id", "name"]
        assert L.lookup(df, dim, on).columns == ["x", "ref", "name", "w"]
        assert rows(L.lookup(df, dim, on, ["name"], where=F.col("w") == 9, how="inner")) == [(11, 2, "c")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for bad in (dict(on={}), dict(on=on, how="right"), dict(on=on, columns=["name"], df=dim)):
        with pytest.raises(ConfigError):
            L.lookup(bad.pop("df", df), dim, **bad)


@pytest.mark.parametrize("width", [1, 3, 50])
@pytest.mark.parametrize("closed", [(True, True), (False, True), (True, False)])
def test_range_lookup_against_all_pairs(spark, width, closed):
    rng = random.Random(width)
    left = [(i, lo := rng.randrange(-20, 20), lo + rng.randrange(-2, 12)) for i in range(40)]
    right = [(rng.randrange(-25, 30), f"d{i}") for i in range(40)]
    inside = lambda p, lo, hi: (p >= lo if closed[0] else p > lo) and (p <= hi if closed[1] else p < hi)
    want = [(*a, b[1]) for a in left for b in right if inside(b[0], a[1], a[2])]
    matched = {w[0] for w in want}
    df = spark.createDataFrame(left, "i long, lo long, hi long")
    dim = spark.createDataFrame(right, "p long, name string")
    args = dict(point="p", low=F.col("lo"), high=F.col("hi"), width=width, columns=["name"], closed=closed)
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows(L.range_lookup(df, dim, **args)) == sorted(want, key=key)
    left_want = want + [(*a, None) for a in left if a[0] not in matched]
    assert rows(L.range_lookup(df, dim, **args, how="left")) == sorted(left_want, key=key)


def test_range_lookup_makes_no_cross_join(spark):
    df = spark.range(10).selectExpr("id AS lo", "id + 2 AS hi")
    dim = spark.range(10).selectExpr("id AS p", "id AS v")
    out = L.range_lookup(df, dim, "p", F.col("lo"), F.col("hi"), 2, ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ConfigError):
        L.range_lookup(df, dim, "p", F.col("lo"), F.col("hi"), 0)


# ---- split -----------------------------------------------------------------


def split_brute(parents, details, limit):
    out = []
    for p in parents:
        if p is not None:
            mine = sorted(d for d in details if d[0] == p)
            out += [d[1:] for d in (mine if limit is None else mine[:limit])]
    return sorted(out)


@pytest.mark.parametrize("limit", [None, 0, 2, 1000])
@pytest.mark.parametrize("unique", [False, True])
@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_split_details(spark, limit, unique, threshold):
    parents = [1, 2, 2, None, 3, 9] + [4] * 2500
    details = [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 4, "d"), (2, 4, "d"), (4, 5, "e"), (7, 6, "f"), (None, 0, "z")]
    p = spark.createDataFrame([(x, 0) for x in parents], "order_id long, u long")
    d = spark.createDataFrame(details, "fk long, item long, s string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = S.split_details(p, d, "order_id", "fk", ["item", "s"], limit, unique_parents=unique)
        assert got.columns == ["item", "s"]
        assert sorted(tuple(r) for r in got.collect()) == split_brute(parents, details, limit)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def step(config):
    return StepSpec.parse({"plugin": "order_split", "config": config}).build()


def test_split_step(spark):
    orders = spark.createDataFrame([(7, 42, 12.5), (None, 1, 1.0)], "order_id long, user_id long, amount double")
    items = spark.createDataFrame([(1, 2, 7), (2, 1, 7), (3, 1, 8)], "item_id long, qty long, order_id long")
    asked = []

    def table(connection, name, columns, key, keys):
        asked.append((connection, name, columns, key, rows(keys)))
        return items

    ctx = StepContext(source_connection="shop", source_table="order_source", table=table)
    config = {
        "detail_table": "order_item", "source_detail_table": "item_source", "detail_columns": ["item_id", "qty"],
        "parent_key": "order_id", "child_key": "order_id", "keep": ["order_id", "user_id"],
    }
    out = step(config)(ctx, {"": orders})
    assert rows(out[""]) == [(None, 1), (7, 42)]
    assert rows(out["order_item"]) == [(1, 2), (2, 1)]
    assert asked == [("shop", "item_source", ("order_id", "item_id", "qty"), "order_id", [(None,), (7,)])]


def test_split_step_defaults_and_missing_parent(spark):
    orders = spark.createDataFrame([(7, 42)], "order_id long, user_id long")
    items = spark.createDataFrame([(1, 7)], "item_id long, order_id long")
    ctx = StepContext(table=lambda c, t, **wanted: items)
    out = step({"detail_table": "d", "parent_key": "order_id"})(ctx, {"": orders})
    assert out[""].columns == ["order_id", "user_id"] and rows(out["d"]) == [(1, 7)]
    out = step({"detail_table": "d", "parent_key": "nope"})(ctx, {"": orders})
    assert list(out) == [""]


# ---- upsert ----------------------------------------------------------------


def merge_brute(old, new):
    """old: {k: (a, b)}, new: {k: a}."""
    out = {k: (new.get(k, a), b) for k, (a, b) in old.items()}
    out.update({k: (a, None) for k, a in new.items() if k not in old})
    return sorted((k, *v) for k, v in out.items())


@pytest.mark.parametrize("small", [True, False, None])
def test_merge(spark, small):
    old = {1: ("a", "x"), 2: ("b", "y"), 3: (None, "z")}
    new = {2: None, 3: "c", 4: "d"}
    target = spark.createDataFrame([(k, *v) for k, v in old.items()], "id long, a string, b string")
    source = spark.createDataFrame(list(new.items()), "id int, a string")
    got = U.merge(target, source, ["id"], small)
    assert got.columns == ["id", "a", "b"] and got.schema["id"].dataType.simpleString() == "bigint"
    assert sorted(tuple(r) for r in got.collect()) == merge_brute(old, new)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    old=st.dictionaries(st.integers(0, 8), st.tuples(st.sampled_from("ab"), st.sampled_from("xy")), max_size=6),
    new=st.dictionaries(st.integers(0, 8), st.sampled_from("abc"), max_size=6),
)
def test_merge_property(spark, old, new):
    target = spark.createDataFrame([(k, *v) for k, v in old.items()], "id long, a string, b string")
    source = spark.createDataFrame(list(new.items()), "id long, a string")
    want = merge_brute(old, new)
    for small in (True, False):
        once = U.merge(target, source, ["id"], small)
        assert sorted(tuple(r) for r in once.collect()) == want
        assert sorted(tuple(r) for r in U.merge(once, source, ["id"], small).collect()) == want


def test_merge_spreads_rows_without_a_key(spark):
    target = spark.range(0, 3000, 1, 8).selectExpr("CASE WHEN id % 3 > 0 THEN id END AS k", "id AS v")
    source = spark.range(0, 3000, 1, 8).selectExpr("id AS k", "-id AS v")
    held = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        merged = U.merge(target, source, ["k"], small_source=False)
        got = merged.withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r["k"], r["v"]) for r in got if r["k"] is not None) == [(i, -i) for i in range(3000)]
    alone = [r for r in got if r["k"] is None]
    assert sorted(r["v"] for r in alone) == list(range(0, 3000, 3))
    tasks = [r["task"] for r in alone]
    assert max(map(tasks.count, set(tasks))) < 250


@pytest.mark.parametrize("small", [True, False])
def test_merge_null_keys_never_match(spark, small):
    target = spark.createDataFrame([(None, "t"), (1, "u")], "id long, a string")
    source = spark.createDataFrame([(None, "s")], "id long, a string")
    assert rows(U.merge(target, source, ["id"], small)) == [(None, "s"), (None, "t"), (1, "u")]


@pytest.mark.parametrize("small", [True, False])
def test_merge_composite_and_keys_only(spark, small):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k1 long, k2 long, v string")
    source = spark.createDataFrame([(1, 2, "c"), (2, 2, "d")], "k1 long, k2 long, v string")
    assert rows(U.merge(target, source, ["k1", "k2"], small)) == [(1, 1, "a"), (1, 2, "c"), (2, 2, "d")]
    keys = source.select("k1", "k2")
    assert rows(U.merge(target, keys, ["k1", "k2"], small)) == [(1, 1, "a"), (1, 2, "b"), (2, 2, None)]


def test_inserts_and_updates(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, a string")
    source = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (4, "d")], "id long, a string")
    assert rows(U.inserts(target, source, ["id"])) == [(4, "d")]
    assert rows(U.inserts(target, source, ["id"], small_source=False)) == [(4, "d")]
    assert rows(U.updates(target, source, ["id"])) == [(2, "B"), (3, "c")]
    assert rows(U.updates(target, source.select("id"), ["id"])) == []


def test_merge_refuses(spark):
    target = spark.createDataFrame([(1, "a")], "id long, a string")
    for source, keys in (
        (target, []),
        (target.select("a"), ["id"]),
        (target.withColumnRenamed("a", "z"), ["id"]),
    ):
        with pytest.raises(ConfigError):
            U.merge(target, source, keys)


def test_small_source_does_not_shuffle_the_target(spark, work):
    spark.range(1000).selectExpr("id", "id AS a").write.parquet(work + "/t")
    spark.range(5).selectExpr("id", "-id AS a").write.parquet(work + "/s")
    target, source = spark.read.parquet(work + "/t"), spark.read.parquet(work + "/s")
    plan = U.merge(target, source, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


# ---- routing and pages -----------------------------------------------------


def test_route(spark):
    df = spark.range(100).selectExpr("id % 10 AS id", "id AS v")
    parts = route(df, 3, ["id"]).select("id", F.spark_partition_id().alias("p")).distinct()
    assert parts.count() == 10
    assert route(df, 3, ["id"]).rdd.getNumPartitions() == 3
    even = route(df, 3).groupBy(F.spark_partition_id()).count().collect()
    assert len(even) == 3
    assert route(df, 1, ["id"]).select(F.spark_partition_id()).distinct().count() == 1
    buckets = df.select("id", bucket_of(["id"], 4).alias("b")).distinct().collect()
    assert len(buckets) == 10 and {r["b"] for r in buckets} <= {0, 1, 2, 3}
    for bad in (lambda: route(df, 0), lambda: bucket_of(["id"], 0)):
        with pytest.raises(ConfigError):
            bad()


def test_fan_out(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "_table string, v long")
    out = fan_out(df, ["a", "b", "c"])
    assert rows(out["a"]) == [(1,), (3,)]
    assert rows(table_counts(out)) == [("a", 2), ("b", 1), ("c", 0)]


@pytest.mark.parametrize("deep", [0, 10**9])
@pytest.mark.parametrize("kind", ["bigint", "timestamp_ntz", "string"])
def test_pages(spark, monkeypatch, deep, kind):
    monkeypatch.setattr("rowtide.sources.tables.DEEP_PAGE", deep)
    rng = random.Random(3)
    # One value holds a third of the rows, some are null.
    data = [(None if rng.random() < 0.05 else 500 if rng.random() < 0.33 else rng.randrange(1000), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k long, id long")
    lead = "timestamp_seconds(k)" if kind == "timestamp_ntz" else "lpad(k, 5, '0')" if kind == "string" else "k"
    df = df.selectExpr(f"CAST({lead} AS {kind}) AS k2", "k", "id")
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for offset, limit in ((0, 10), (90, 50), (700, 300), (1990, 100), (5000, 10), (0, 2000)):
        got = [(r["k"], r["id"]) for r in page(df, ["k2", "id"], offset, limit).collect()]
        assert got == ordered[offset : offset + limit]
    with pytest.raises(ConfigError):
        page(df, [], 0, 1)


def test_deep_pages_of_extreme_values(spark, monkeypatch):
    monkeypatch.setattr("rowtide.sources.tables.DEEP_PAGE", 0)
    data = [(v, i) for i, v in enumerate([-(2**63), 2**63 - 1, 0, 1, -1, 5, 5, 5, 2**62, None])] + [(5, 5)] * 3
    df = spark.createDataFrame(data, "k long, id long")
    ordered = sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for offset in range(len(data)):
        assert [tuple(r) for r in page(df, ["k"], offset, 3).collect()] == ordered[offset : offset + 3]


@pytest.fixture
def skew_settings(spark):
    """Adaptive skew handling at the scale of a test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.shuffle.partitions": "20",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("limit", [None, 3])
def test_a_crowded_lookup_key_is_split(spark, work, skew_settings, limit):
    spark.range(60_000).selectExpr("IF(id % 3 = 0, 1, id % 500) AS ref", "uuid() AS payload").repartition(8).write.parquet(work + "/f")
    spark.range(500).selectExpr("id", "id AS name").write.parquet(work + "/d")
    facts, dim = spark.read.parquet(work + "/f"), spark.read.parquet(work + "/d")
    out = L.lookup(facts, dim, {"ref": "id"}, ["name"], limit=limit)
    out.write.format("noop").mode("overwrite").save()
    got = out.groupBy("ref", "name").count()
    assert got.where("name IS NULL OR name <> ref").count() == 0 and out.count() == 60_000
    assert "skew=true" in _final_plan(out)


def test_a_crowded_detail_key_is_split(spark, work, skew_settings):
    spark.range(60_000).selectExpr("IF(id % 3 = 0, 1, id % 500) AS fk", "uuid() AS payload").repartition(8).write.parquet(work + "/d")
    spark.range(500).selectExpr("id AS oid").write.parquet(work + "/p")
    out = S.split_details(spark.read.parquet(work + "/p"), spark.read.parquet(work + "/d"), "oid", "fk", ["payload"], None)
    assert "skew=true" in _final_plan(out)


def _final_plan(df):
    """The plan as adaptive execution ended up with it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_steps(spark):
    from rowtide.operators.steps import StepContext, StepSpec

    facts = spark.createDataFrame([(1, 5), (2, 50), (None, 7)], "ref long, at long")
    dim = spark.createDataFrame([(1, "a", 3), (1, "b", 2), (2, "c", 1), (9, "d", 60)], "id long, name string, w long")
    ctx = StepContext(source_connection="c", table=lambda c, t, columns=(), key=None, keys=None: dim)
    step = StepSpec.parse({"lookup": {"table": "dim", "on": {"ref": "id"}, "columns": ["name"], "where": "w < :m", "params": {"m": 3}, "limit": 1, "order": ["w"]}}).build()
    assert rows(step(ctx, {"": facts})[""]) == [(None, 7, None), (1, 5, "b"), (2, 50, "c")]
    ranged = {"table": "dim", "point": "w", "low": "ref", "high": "at", "width": 10, "columns": ["name"]}
    step = StepSpec.parse({"range_lookup": ranged}).build()
    assert rows(step(ctx, {"": facts})[""]) == [(1, 5, "a"), (1, 5, "b"), (1, 5, "c"), (2, 50, "a"), (2, 50, "b")]
    got = ctx.lookup_table("c", "dim", ["name"], key="id", where="w > 1", limit=1, order=["w"])
    assert rows(got) == [("b",), ("d",)]
    for bad in (None, {"table": "dim"}, {"table": "d", "on": {"a": "b"}, "limit": 0}, {"table": "d", "on": {"a": "b"}, "x": 1}):
        with pytest.raises(ConfigError):
            StepSpec.parse({"lookup": bad}).build()
    with pytest.raises(ConfigError):
        ctx.lookup_table("c", "dim", limit=1)


@pytest.mark.parametrize(("low", "high"), [(0, 0), (-5, 9), (3, 1), (-(2**40), 2**41 + 7), (7, 8), (-1, 0)])
def test_ranges_are_covered_by_few_nodes(spark, low, high):
    nodes = spark.range(1).select(F.inline(L.cover(F.lit(low).cast("bigint"), F.lit(high).cast("bigint")))).collect()
    spans = sorted((r["node"] << r["level"], ((r["node"] + 1) << r["level"]) - 1) for r in nodes)
    assert len(spans) <= 2 * 42
    if low > high:
        assert spans == []
    else:
        assert spans[0][0] == low and spans[-1][1] == high
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_a_range_over_the_whole_axis_is_a_few_rows(spark):
    """Before the join a row stands once for each node, not once for each bucket."""
    df = spark.createDataFrame([(1, -(10**9), 10**9), (2, 5, 9), (3, None, 4)], "id long, lo long, hi long")
    dim = spark.range(-50, 50).selectExpr("id * 1000003 AS p", "id AS v")
    out = L.range_lookup(df, dim, "p", F.col("lo"), F.col("hi"), 1, ["v"])
    assert out.count() == 100
    rows_in = df.select(F.inline(L.cover(F.col("lo"), F.col("hi")))).count()
    assert rows_in < 70
    assert L.range_lookup(df, dim, "p", F.col("lo"), F.col("hi"), 1, ["v"], how="left").count() == 102
