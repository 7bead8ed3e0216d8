"""Guarded casts: Spark's own casts, minus the conversions the value model refuses.

Null stays null.  A value that cannot be converted fails the query; a type that can
never be converted fails when the plan is built.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError, ExpressionError
from rowtide.functions.text import display_text

INT_NAMES = ("int", "integer", "bigint")
FLOAT_NAMES = ("float", "double")
BOOL_NAMES = ("bool", "boolean")
TEXT_NAMES = ("string", "varchar", "text")
DECIMAL_NAMES = ("decimal", "numeric")

# The words a text may hold to become a boolean.
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")

# Fixed patterns: the number texts that are accepted once trimmed.
INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"(?i)^[+-]?(inf|infinity|nan|([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?)$"

MAX_LONG, MIN_LONG = 2**63 - 1, -(2**63)


def _fail(c: Column, target: str, dtype: str) -> Column:
    message = F.concat(F.lit("cannot cast '"), c.cast("string"), F.lit(f"' to {target}"))
    return F.raise_error(message).cast(dtype)


def _refuse(dtype: T.DataType, kinds: tuple[str, ...], target: str) -> None:
    if V.value_class(dtype) in kinds:
        raise ExpressionError(f"cannot cast {dtype.simpleString()} to {target}")


def _trim(c: Column) -> Column:
    """Both ends without white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def to_int(c: Column, dtype: T.DataType) -> Column:
    """Whole numbers; floating values truncate and saturate, text must be an integer."""
    _refuse(dtype, (V.BOOL, V.BYTES, V.DATE), "int")
    if V.is_floating(dtype):
        top, bottom = F.lit(float(MAX_LONG)), F.lit(float(MIN_LONG))
        return (
            F.when(F.isnan(c), F.lit(0))
            .when(c >= top, F.lit(MAX_LONG))
            .when(c <= bottom, F.lit(MIN_LONG))
            .otherwise(c.cast("bigint"))
        )
    if isinstance(dtype, T.DecimalType):
        if dtype.scale == 0:
            return c.cast("bigint")
        return F.when(c == F.floor(c), c.cast("bigint")).when(
            c.isNotNull(), _fail(c, "int", "bigint")
        )
    if V.value_class(dtype) == V.TEXT:
        text = _trim(c)
        return F.when(text.rlike(INT_TEXT), text.cast("bigint")).when(
            c.isNotNull(), _fail(c, "int", "bigint")
        )
    return c.cast("bigint")


def to_float(c: Column, dtype: T.DataType) -> Column:
    _refuse(dtype, (V.BOOL, V.BYTES, V.DATE), "float")
    if V.value_class(dtype) == V.TEXT:
        text = _trim(c)
        return F.when(text.rlike(FLOAT_TEXT), text.cast("double")).when(
            c.isNotNull(), _fail(c, "float", "double")
        )
    return c.cast("double")


def to_bool(c: Column, dtype: T.DataType) -> Column:
    """Booleans, whole numbers (not zero) and the fixed words; nothing else."""
    _refuse(dtype, (V.DATE, V.BYTES), "bool")
    kind = V.value_class(dtype)
    if kind == V.TEXT:
        word = F.lower(_trim(c))
        return (
            F.when(word.isin(*TRUE_WORDS), F.lit(True))
            .when(word.isin(*FALSE_WORDS), F.lit(False))
            .when(c.isNotNull(), _fail(c, "bool", "boolean"))
        )
    if kind == V.NUMBER:
        if not isinstance(dtype, T.IntegralType):
            raise ExpressionError(f"cannot cast {dtype.simpleString()} to bool")
        return c != F.lit(0)
    return c.cast("boolean")


def to_text(c: Column, dtype: T.DataType) -> Column:
    return display_text(c, dtype)


def to_decimal(c: Column, dtype: T.DataType, target: T.DecimalType) -> Column:
    """Exact numbers; text that is no number fails here rather than at the target."""
    _refuse(dtype, (V.BOOL, V.DATE, V.BYTES), "decimal")
    return c.cast(target)


_DECIMAL_ARGS = re.compile(r"(\w+)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")


def cast_column(c: Column, dtype: T.DataType, type_name: str) -> Column:
    """``c`` cast to the named type.

    Names are case-insensitive; ``decimal`` takes an optional ``(p, s)``.
    """
    name = type_name.strip().lower()
    precision = V.DEFAULT_DECIMAL
    sized = _DECIMAL_ARGS.fullmatch(name)
    if sized and sized[1] in DECIMAL_NAMES:
        name, precision = sized[1], T.DecimalType(int(sized[2]), int(sized[3] or 0))
    if V.value_class(dtype) == V.NULL:
        return c.cast(target_type(name, precision))
    if name in INT_NAMES:
        return to_int(c, dtype)
    if name in FLOAT_NAMES:
        return to_float(c, dtype)
    if name in BOOL_NAMES:
        return to_bool(c, dtype)
    if name in TEXT_NAMES:
        return to_text(c, dtype)
    if name in DECIMAL_NAMES:
        return to_decimal(c, dtype, precision)
    raise ConfigError(f"unsupported cast type {type_name!r}")


def target_type(name: str, precision: T.DecimalType) -> T.DataType:
    for names, dtype in (
        (INT_NAMES, T.LongType()),
        (FLOAT_NAMES, T.DoubleType()),
        (BOOL_NAMES, T.BooleanType()),
        (TEXT_NAMES, T.StringType()),
        (DECIMAL_NAMES, precision),
    ):
        if name in names:
            return dtype
    raise ConfigError(f"unsupported cast type {name!r}")
