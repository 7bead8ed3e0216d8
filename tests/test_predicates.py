from __future__ import annotations

from decimal import Decimal

import pytest
from frames import rows
from pyspark.sql import functions as F

from rowtide.errors import ExpressionError
from rowtide.functions.predicates import condition
from rowtide.operators.steps import filter_rows


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(1, 1), (2, 3), (3, 5), (4, None)], "id long, k long")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, ""), (4, None), (5, "123")], "id long, s string")


def ids(df, **conf):
    return [r[0] for r in rows(filter_rows(df, **conf).select("id"))]


@pytest.mark.parametrize(
    ("expr", "want"),
    [
        ("k eq 3", [2]),
        ("k ne 3", [1, 3, 4]),
        ("k gt 3", [3]),
        ("k gte 3", [2, 3, 4]),
        ("k lt 3", [1]),
        ("k lte 3", [1, 2, 4]),
        ("k is null", [4]),
        ("k not null", [1, 2, 3]),
        ("k eq null", []),
        ("k ne null", [1, 2, 3, 4]),
        ("k gte null", [1, 2, 3, 4]),
        ("k gt null", []),
        ("k eq '3'", []),
        ("k eq true", []),
        ("k ne true", [1, 2, 3, 4]),
        ("k eq 3.0", [2]),
        ("k gt 2.5", [2, 3]),
        ("k lt abc", [1, 2, 3, 4]),
        ("k gt abc", []),
        ("k eq $id", [1]),
        ("k gte $id", [1, 2, 3, 4]),
        ("k lt $id", []),
        ("nope eq 1", []),
        ("nope ne 1", [1, 2, 3, 4]),
        ("nope is null", [1, 2, 3, 4]),
        ("nope gte 1", [1, 2, 3, 4]),
        ("k eq $nope", []),
    ],
)
def test_numbers(numbers, expr, want):
    assert ids(numbers, keep=expr) == want
    assert ids(numbers, drop=expr) == [i for i in (1, 2, 3, 4) if i not in want]


@pytest.mark.parametrize(
    ("expr", "want"),
    [
        ("s eq a", [1]),
        ("s eq 'a'", [1]),
        ("s ne a", [2, 3, 4, 5]),
        ("s gt a", [2]),
        ("s gte a", [1, 2]),
        ("s lt a", [3, 4, 5]),
        ("s lte a", [1, 3, 4, 5]),
        ("s eq ''", [3]),
        ("s gte ''", [1, 2, 3, 4, 5]),
        ("s lte ''", [3, 4]),
        ("s gt ''", [1, 2, 5]),
        ("s eq 123", []),
        ("s eq '123'", [5]),
        ("s ne 123", [1, 2, 3, 4, 5]),
        ("s gt 123", [1, 2, 5]),
        ("s gte 123", [1, 2, 3, 4, 5]),
        ("s lt 123", []),
        ("s lte 123", [3, 4]),
        ("s is null", [4]),
        ("s eq $s", [1, 2, 3, 5]),
        ("s lte $nope", [3, 4]),
    ],
)
def test_texts(texts, expr, want):
    assert ids(texts, keep=expr) == want
    assert ids(texts, drop=expr) == [i for i in (1, 2, 3, 4, 5) if i not in want]


def test_booleans(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, b boolean")
    assert ids(df, keep="b eq true") == [1]
    assert ids(df, keep="b ne true") == [2, 3]
    assert ids(df, keep="b gt false") == []
    assert ids(df, keep="b gte true") == [1, 2, 3]
    assert ids(df, keep="b lt true") == []
    assert ids(df, keep="b eq 1") == []


def test_doubles_use_epsilon(spark):
    df = spark.createDataFrame([(1, 0.1 + 0.2), (2, 0.3), (3, 0.31), (4, None), (5, float("nan"))], "id long, x double")
    assert ids(df, keep="x eq 0.3") == [1, 2]
    assert ids(df, keep="x ne 0.3") == [3, 4, 5]
    assert ids(df, keep="x eq nan") == []
    assert ids(df, keep="x eq $x") == [1, 2, 3]
    big = spark.createDataFrame([(1, 1e17), (2, 1e17 + 16)], "id long, x double")
    assert ids(big, keep="x eq 1e17") == [1]


def test_decimals_count_as_text_beside_null(spark):
    df = spark.createDataFrame(
        [(1, Decimal("5.00"), None), (2, Decimal("5.00"), 4), (3, None, 4), (4, None, None)],
        "id long, d decimal(10,2), n long",
    )
    assert ids(df, keep="d gt $n") == [1, 2]
    assert ids(df, keep="d gte $n") == [1, 2, 3, 4]
    assert ids(df, keep="d lt $n") == []
    assert ids(df, keep="d lte $n") == [3, 4]
    assert ids(df, keep="d eq 5") == [1, 2]
    assert ids(df, keep="d gt null") == [1, 2]
    assert ids(df, keep="d gte 6") == [3, 4]
    assert ids(df, keep="$d gte 6") == [1, 2, 3, 4]


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_dates_compare_by_canonical_text(spark, kind):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "id long, t string")
    df = df.select("id", F.col("t").cast(kind).alias("d"))
    assert ids(df, keep="d eq 2024-01-01") == [1]
    assert ids(df, keep="d ne 2024-01-01") == [2, 3]
    assert ids(df, keep="d gt 2024-01-01") == [2]
    assert ids(df, keep="d gte '2024-01-01'") == [1, 2]
    assert ids(df, keep="d lt 2024-01-02") == [1, 3]
    assert ids(df, keep="d lte 2023") == [3]
    assert ids(df, keep="d gt 5") == [1, 2]
    assert ids(df, keep="d gte $d") == [1, 2, 3]
    assert ids(df, keep="d lt $d") == []


def test_native_forms_reach_the_scan(spark, work):
    spark.range(100).selectExpr("id", "id * 1.0D AS x", "cast(id AS string) AS s").write.parquet(work + "/t")
    df = spark.read.parquet(work + "/t")
    for expr, pushed in [
        ("id gte 3", "Or(IsNull(id),GreaterThanOrEqual(id,3))"),
        ("id gt 3", "GreaterThan(id,3)"),
        ("id eq 3", "EqualTo(id,3)"),
        ("s lt b", "Or(IsNull(s),LessThan(s,b))"),
        ("x eq 3.5", "GreaterThanOrEqual(x,3.4999"),
    ]:
        plan = df.where(condition(expr, df))._jdf.queryExecution().executedPlan().toString()
        assert pushed in plan, expr


@pytest.mark.parametrize("expr", ["k gt", "k gt 1 2", "k like a", "k between 3", "k is 3", "k not abc", ""])
def test_refused(numbers, expr):
    with pytest.raises(ExpressionError):
        condition(expr, numbers)


def test_null_test_against_a_column(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, None)], "id long, k long, n long")
    assert ids(df, keep="k is $n") == [1]
    bad = spark.createDataFrame([(1, 1, 1)], "id long, k long, n long")
    with pytest.raises(Exception, match="needs null on its right side"):
        filter_rows(bad, keep="k is $n").collect()


@pytest.mark.parametrize(("text", "pushed", "want"), [
    ("id gt 2.5", "GreaterThan(id,2)", [3, 4]), ("id gte 2.5", "GreaterThanOrEqual(id,3)", [None, 3, 4]), ("id lt 2.5", "LessThan(id,3)", [1, 2]),
    ("id lte -0.5", "LessThanOrEqual(id,-1)", [None]), ("id gt 1e300", None, []),
])
def test_fractions_reach_the_scan_of_whole_numbers(spark, work, text, pushed, want):
    spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "id long").write.parquet(work + "/t")
    df = filter_rows(spark.read.parquet(work + "/t"), keep=text)
    assert sorted((r["id"] for r in df.collect()), key=lambda v: (v is not None, v)) == want
    assert pushed is None or pushed in df._jdf.queryExecution().executedPlan().toString()
