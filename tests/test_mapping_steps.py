from __future__ import annotations

import pytest
from frames import rows
from pyspark.sql import types as T

import rowtide  # noqa: F401  registers the split step
from rowtide.errors import ConfigError
from rowtide.operators import mapping as M
from rowtide.operators import steps as E


@pytest.fixture(scope="module")
def abc(spark):
    return spark.createDataFrame([(1, "x", 2.5), (2, None, 3.5)], "a long, b string, c double")


def test_map_both_lists(abc):
    df = M.map_columns(abc, ["a", "b", "nope", "c"], ["x", "y", "z"])
    assert df.columns == ["x", "y", "z"] and rows(df) == [(1, "x", None), (2, None, None)]


def test_map_shorter_source_and_repeated_target(abc):
    assert M.map_columns(abc, ["a"], ["x", "y"]).columns == ["x"]
    df = M.map_columns(abc, ["a", "c"], ["x", "x"])
    assert df.columns == ["x"] and rows(df) == [(2.5,), (3.5,)]


def test_map_one_list_or_none(abc):
    assert M.map_columns(abc, target=["b", "q"]).columns == ["b", "q"]
    assert M.map_columns(abc, source=["c", "a"]).columns == ["c", "a"]
    assert M.map_columns(abc) is abc
    assert M.map_columns(abc, target=["q"], null_type="bigint").schema["q"].dataType == T.LongType()


def test_keep_project_union(abc):
    assert M.keep_columns(abc, ["c", "nope", "a"]).columns == ["c", "a"]
    assert M.keep_columns(abc) is abc
    assert M.project(abc, ["nope", "a"]).columns == ["nope", "a"]
    both = M.union_normalised([abc.select("a"), abc.select("b", "a")])
    assert both.columns == ["a", "b"] and both.count() == 4
    with pytest.raises(ConfigError):
        M.union_normalised([])


def test_rename_in_order(abc):
    assert E.rename(abc, [("a", "b")]).columns == ["c", "b"]
    assert rows(E.rename(abc, [("a", "b")]).select("b")) == [(1,), (2,)]
    df = E.rename(abc, [("a", "t"), ("b", "a"), ("t", "b"), ("nope", "c")])
    assert sorted(df.columns) == ["a", "b", "c"] and rows(df.select("b")) == [(1,), (2,)]
    assert E.rename(abc, [("a", "a")]).columns == ["b", "c", "a"]


def test_set_constants(abc):
    df = E.set_constants(abc, {"c": None, "d": {"t": "Int", "v": 7}, "e": "z", "n": None})
    assert [f.dataType for f in df.schema.fields] == [
        T.LongType(), T.StringType(), T.DoubleType(), T.LongType(), T.StringType(), T.StringType()
    ]
    assert rows(df)[0] == (1, "x", None, 7, "z", None)


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` long, c long")
    assert E.rename(df, [("a.b", "x.y")]).columns == ["c", "x.y"]
    assert rows(E.filter_rows(df, keep="a.b eq 1")) == [(1, 2)]
    assert rows(E.set_constants(df, {"a.b": 5})) == [(5, 2)]
    assert rows(M.map_columns(df, ["a.b"], ["z"])) == [(1,)]


def test_keep_and_drop_combine(abc):
    assert E.filter_rows(abc, keep="a gt 0", drop="b is null").count() == 1


@pytest.mark.parametrize(
    ("raw", "name", "config"),
    [
        ({"rename": {"column": []}}, "rename", {"column": []}),
        ({"plugin": "order_split", "config": {"k": 1}}, "order_split", {"k": 1}),
        ({"builtin": "cast", "config": None}, "cast", None),
        ("filter", "filter", None),
        ({"tables": "t", "set": {"constant": {}}}, "set", {"constant": {}}),
    ],
)
def test_step_shapes(raw, name, config):
    spec = E.StepSpec.parse(raw)
    assert (spec.name, spec.config) == (name, config)


@pytest.mark.parametrize("raw", [{}, None, 3, {"plugin": ""}, "", {"tables": "t"}])
def test_bad_step_shapes(raw):
    with pytest.raises(ConfigError):
        E.StepSpec.parse(raw)


@pytest.mark.parametrize(
    "raw",
    [
        "nope",
        {"rename": {"column": [{"from": "a"}]}},
        {"cast": {"column": [{"name": "a"}]}},
        {"filter": {"keep": "a eq"}},
        {"set": {"constant": {"a": [1]}}},
        {"order_split": None},
        {"order_split": {"detail_table": "d"}},
        {"order_split": {"parent_key": "p", "detail_table": " "}},
        {"order_split": {"parent_key": "p", "detail_table": "d", "limit": "x"}},
    ],
)
def test_bad_configuration_is_refused_when_built(raw):
    with pytest.raises(ConfigError):
        E.StepSpec.parse(raw).build()


def test_chain_and_branches(abc):
    seen = []

    @E.register_step("split_by_null")
    def make(config):
        def run(ctx, branches):
            df = branches[E.DEFAULT_TABLE]
            seen.append(ctx.source_table)
            return {**branches, "": df.where("b IS NOT NULL"), "nulls": df.where("b IS NULL")}

        return run

    specs = ["split_by_null", {"set": {"constant": {"k": 1}}}, {"set": {"constant": {"k": "n"}}, "tables": ["nulls"]}]
    run = E.chain([E.StepSpec.parse(s).build() for s in specs])
    out = run(E.StepContext(source_table="t"), {"": abc})
    # A later step leaves other tables' rows where they are.
    assert rows(out[""].select("a", "k")) == [(1, 1)] and rows(out["nulls"].select("a", "k")) == [(2, "n")]
    assert seen == ["t"]
    assert E.chain([])(E.StepContext(), {"": abc})[""] is abc
    with pytest.raises(ConfigError):
        E.on_tables(run, ["missing"])(E.StepContext(), {"": abc})


def test_row_step(spark):
    def explode(row):
        if row["n"] is None:
            return
        yield "", {"id": row["id"]}
        for i in range(row["n"]):
            yield "items", {"id": row["id"], "i": i}

    schemas = {
        "": T._parse_datatype_string("id bigint"),
        "items": T._parse_datatype_string("id bigint, i bigint"),
    }
    df = spark.createDataFrame([(2**60 + 1, 2), (5, 0), (6, None)], "id bigint, n bigint")
    out = E.RowStep(explode, schemas)(E.StepContext(), {"": df})
    assert rows(out[""]) == [(2**60 + 1,), (5,)]
    assert rows(out["items"]) == [(2**60 + 1, 0), (2**60 + 1, 1)]

    def lost(row):
        yield "nowhere", {}

    with pytest.raises(Exception, match="undeclared table"):
        E.RowStep(lost, schemas)(E.StepContext(), {"": df})[""].collect()
    with pytest.raises(ConfigError):
        E.RowStep(lost, {"a": schemas[""], "b": T._parse_datatype_string("id string")}).union_schema()


def test_row_step_flushes_large_outputs(spark):
    def many(row):
        for i in range(25_000):
            yield "", {"i": i}

    step = E.RowStep(many, {"": T._parse_datatype_string("i bigint")})
    out = step(E.StepContext(), {"": spark.range(2).coalesce(1)})[""]
    assert out.count() == 50_000


def test_batch_step(spark):
    """Missing columns are null, undeclared ones go, types follow the declaration, no rows are fine."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def deal(batch):
        odd = batch.filter(pc.equal(pc.bit_wise_and(batch["i"], 1), 1))
        return {"": batch.append_column("more", batch["i"]), "odd": odd.select(["i"]), "none": pa.table({"name": pa.array([], pa.string())})}

    schemas = {"": "i int, name string", "odd": "i int, note string", "none": "name string"}
    step = E.BatchStep(deal, {t: T._parse_datatype_string(x) for t, x in schemas.items()})
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "i long, name string")
    out = step(E.StepContext(), {"": df, "kept": df})
    assert rows(out[""]) == [(1, "a"), (2, None), (3, "c")] and out[""].dtypes == [("i", "int"), ("name", "string")]
    assert rows(out["odd"]) == [(1, None), (3, None)] and rows(out["none"]) == [] and rows(out["kept"]) == rows(df)
    assert rows(step(E.StepContext(), {"": df.limit(0)})["odd"]) == []
    with pytest.raises(Exception, match="undeclared table 'lost'"):
        E.BatchStep(lambda batch: {"lost": batch}, step.tables)(E.StepContext(), {"": df})[""].collect()
