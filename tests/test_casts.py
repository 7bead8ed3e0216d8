from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError, ExpressionError
from rowtide.functions import text as X
from rowtide.operators.steps import cast_columns


def cast_one(spark, value, dtype, to):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("c", T._parse_datatype_string(dtype))]))
    return cast_columns(df, [("c", to)]).first()[0]


@pytest.mark.parametrize(
    ("value", "dtype", "to", "want"),
    [
        (" 12 ", "string", "int", 12),
        ("+5", "string", "integer", 5),
        ("\t-7\n", "string", "BIGINT", -7),
        (12.9, "double", "int", 12),
        (-12.9, "double", "int", -12),
        (1e30, "double", "int", 2**63 - 1),
        (-1e30, "double", "int", -(2**63)),
        (float("nan"), "double", "int", 0),
        (Decimal("12.00"), "decimal(10,2)", "int", 12),
        (Decimal("18"), "decimal(20,0)", "int", 18),
        (7, "int", "float", 7.0),
        (" 1e3 ", "string", "double", 1000.0),
        ("inf", "string", "double", float("inf")),
        (Decimal("2.50"), "decimal(10,2)", "float", 2.5),
        ("YES", "string", "bool", True),
        (" y ", "string", "bool", True),
        ("1", "string", "bool", True),
        ("No", "string", "boolean", False),
        (0, "bigint", "bool", False),
        (-3, "int", "bool", True),
        (True, "boolean", "bool", True),
        (1.0, "double", "string", "1"),
        (0.1, "double", "string", "0.1"),
        (12345678.9, "double", "string", "12345678.9"),
        (1e-7, "double", "string", "0.0000001"),
        (1.5e21, "double", "string", "1500000000000000000000"),
        (-2.5e-5, "double", "text", "-0.000025"),
        (1e7, "double", "string", "10000000"),
        (float("inf"), "double", "string", "inf"),
        (True, "boolean", "varchar", "true"),
        (bytearray(b"\xab\x01"), "binary", "string", "0xAB01"),
        (Decimal("12.50"), "decimal(10,2)", "string", "12.50"),
        (5, "bigint", "string", "5"),
        (1.25, "double", "decimal(10,2)", Decimal("1.25")),
        ("12.5", "string", "DECIMAL(10,2)", Decimal("12.50")),
        (3, "bigint", "numeric", Decimal("3.000000000000000000")),
    ],
)
def test_values(spark, value, dtype, to, want):
    got = cast_one(spark, value, dtype, to)
    assert got == want and type(got) is type(want)


@pytest.mark.parametrize("to", ["int", "float", "bool", "string", "decimal"])
@pytest.mark.parametrize("dtype", ["string", "bigint"])
def test_null_stays_null(spark, to, dtype):
    assert cast_one(spark, None, dtype, to) is None


@pytest.mark.parametrize(
    ("value", "to"),
    [("12.5", "int"), ("1e3", "int"), ("abc", "int"), ("", "int"), ("t", "bool"), ("2", "bool"), ("1d", "float"),
     ("abc", "decimal")],
)
def test_bad_text_fails_the_query(spark, value, to):
    with pytest.raises(Exception, match="(?i)cast"):
        cast_one(spark, value, "string", to)


def test_fractional_decimal_is_no_int(spark):
    with pytest.raises(Exception, match="cannot cast '12.50' to int"):
        cast_one(spark, Decimal("12.50"), "decimal(10,2)", "int")


@pytest.mark.parametrize(
    ("dtype", "to"),
    [
        ("boolean", "int"), ("binary", "int"), ("date", "int"), ("timestamp", "int"),
        ("boolean", "float"), ("timestamp", "float"), ("binary", "float"),
        ("double", "bool"), ("decimal(10,2)", "bool"), ("decimal(20,0)", "bool"), ("date", "bool"), ("binary", "bool"),
        ("boolean", "decimal"), ("date", "decimal"), ("timestamp", "decimal"), ("binary", "decimal"),
    ],
)
def test_refused_when_planned(spark, dtype, to):
    df = spark.createDataFrame([], f"c {dtype}")
    with pytest.raises(ExpressionError):
        cast_columns(df, [("c", to)])


def test_unknown_type_and_missing_column(spark):
    df = spark.createDataFrame([(1,)], "c int")
    with pytest.raises(ConfigError):
        cast_columns(df, [("c", "money")])
    assert cast_columns(df, [("nope", "int")]).columns == ["c"]


def test_repeated_cast_applies_in_order(spark):
    df = spark.createDataFrame([(1.9,)], "c double")
    assert cast_columns(df, [("c", "int"), ("c", "string")]).first()[0] == "1"


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("2024-01-02 00:00:00", "2024-01-02"),
        ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
        ("2024-01-02 03:04:05.5", "2024-01-02 03:04:05.500000"),
    ],
)
def test_moment_text(spark, kind, given, want):
    df = spark.createDataFrame([(given,)], "t string").select(F.col("t").cast(kind).alias("t"))
    assert cast_columns(df, [("t", "string")]).first()[0] == want
    assert X.python_moment_text(dt.datetime.fromisoformat(given)) == want


def test_time_text(spark):
    df = spark.createDataFrame([(3661,), (90000,), (-61,), (None,)], "s int").select(X.time_text(F.col("s")))
    assert [r[0] for r in df.collect()] == ["01:01:01", "25:00:00", "-00:01:01", None]


def test_literal_text():
    cases = {
        "NULL": None, "1": True, "0": False, "42": 42, "1.5": 1.5, "2": 2.0, "'it''s'": "it's", "X'AB01'": b"\xab\x01",
        "'2024-01-02'": dt.datetime(2024, 1, 2), "'1.50'": Decimal("1.50"), "'2024-01-03'": dt.date(2024, 1, 3),
    }
    for want, value in cases.items():
        assert X.literal_text(value) == want


def test_constants():
    p = V.parse_constant
    assert p(42) == V.Constant(42, T.LongType())
    assert p({"t": "Int", "v": 42}) == V.Constant(42, T.LongType())
    assert p(2**63).dtype == V.UINT64
    assert p({"t": "UInt", "v": 2**64 - 1}).value == Decimal(2**64 - 1)
    assert p({"t": "Decimal", "v": "12.50"}) == V.Constant(Decimal("12.50"), T.DecimalType(4, 2))
    assert p({"t": "Date", "v": "2024-01-02"}).dtype == T.DateType()
    assert p({"t": "Date", "v": "2024-01-02 03:04:05"}).dtype == T.TimestampNTZType()
    assert p({"t": "Bytes", "v": [1, 255]}).value == bytearray(b"\x01\xff")
    assert p(None).dtype == T.StringType() and p({"t": "Null"}, T.LongType()).dtype == T.LongType()
    assert p("x").dtype == T.StringType() and p(True).dtype == T.BooleanType() and p(1.5).dtype == T.DoubleType()
    for bad in ([1], {"a": 1}, {"t": "Int", "v": "x"}, {"t": "Nope", "v": 1}, {"t": "Decimal", "v": "x"}):
        with pytest.raises(ConfigError):
            p(bad)


def test_lower_bounds():
    assert V.lower_bound(T.LongType()).value == V.lower_bound(None).value == -(2**63)
    assert V.lower_bound(T.StringType()).value == ""
    assert V.lower_bound(T.TimestampNTZType()).value == dt.datetime.min
    assert V.lower_bound(T.DecimalType(10, 2)) == V.Constant(Decimal(-(10**8)), T.DecimalType(9, 0))
    assert V.lower_bound(T.DecimalType(38, 38)).value == 0 and V.lower_bound(T.DoubleType()).value < -1e308
