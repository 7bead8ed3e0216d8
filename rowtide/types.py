"""Value classes of the data model and their Spark types.

A column value belongs to one of a few classes (number, text, date, boolean,
bytes, null).  The class is known from the Spark type when the plan is built,
so no operator inspects values row by row.
"""

from __future__ import annotations

import datetime as dt
import re
import sys
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.errors import ConfigError

NULL, BOOL, NUMBER, TEXT, DATE, BYTES = "null", "bool", "number", "text", "date", "bytes"

# Unsigned 64-bit integers do not fit a Spark long.
UINT64 = T.DecimalType(20, 0)
DEFAULT_DECIMAL = T.DecimalType(38, 18)
EPOCH = dt.datetime(1970, 1, 1)


def value_class(dtype: T.DataType) -> str:
    """The value class of a Spark type; nested types have none and are refused."""
    if isinstance(dtype, T.NullType):
        return NULL
    if isinstance(dtype, T.BooleanType):
        return BOOL
    if isinstance(dtype, T.NumericType):
        return NUMBER
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return DATE
    if isinstance(dtype, T.BinaryType):
        return BYTES
    raise ConfigError(f"column type {dtype.simpleString()} is outside the value model")


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def column_type(df: DataFrame, name: str) -> T.DataType | None:
    """Type of ``name``, or None when the frame has no such column."""
    return next((f.dataType for f in df.schema.fields if f.name == name), None)


def quoted(name: str) -> str:
    """``name`` as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by exact name: a dot in the name does not mean a nested field."""
    return F.col(quoted(name))


@dataclass(frozen=True)
class Constant:
    """A typed literal from a configuration document."""

    value: Any
    dtype: T.DataType

    def column(self) -> Column:
        return F.lit(self.text() if self.is_moment else self.value).cast(self.dtype)

    @property
    def is_moment(self) -> bool:
        return isinstance(self.value, dt.date)

    def text(self) -> str:
        """The value as text that casts back to it.

        Moments go through text: a Python datetime would be shifted by the time zone of
        the Python process.
        """
        if isinstance(self.value, dt.datetime):
            return self.value.isoformat(sep=" ")
        return format(self.value, "f") if isinstance(self.value, Decimal) else str(self.value)


def _whole(v: Any) -> bool:
    return isinstance(v, int) and not isinstance(v, bool)


def _date_constant(text: str) -> Constant:
    moment = parse_moment(text)
    if moment is None:
        raise ConfigError(f"invalid date literal {text!r}")
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", text.strip()):
        return Constant(moment.date(), T.DateType())
    return Constant(moment, T.TimestampNTZType())


def _decimal_constant(text: str) -> Constant:
    number = Decimal(text.strip())
    exponent = number.as_tuple().exponent
    scale = max(0, -exponent)
    whole = max(1, len(number.as_tuple().digits) + exponent)
    if whole + scale > 38:
        raise ConfigError(f"decimal literal {text!r} has more than 38 digits")
    return Constant(number, T.DecimalType(whole + scale, scale))


def parse_constant(raw: Any, null_type: T.DataType | None = None) -> Constant:
    """A literal, plain (``42``) or tagged (``{"t": "Int", "v": 42}``).

    Null has no type of its own: it takes ``null_type``, text if not given.
    Untagged lists and mappings are errors.
    """
    null_type = null_type or T.StringType()
    if isinstance(raw, dict) and "t" in raw:
        tag, v = raw["t"], raw.get("v")
        try:
            if tag == "Null":
                return Constant(None, null_type)
            if tag == "Bool" and isinstance(v, bool):
                return Constant(v, T.BooleanType())
            if tag == "Int" and _whole(v) and -(2**63) <= v < 2**63:
                return Constant(v, T.LongType())
            if tag == "UInt" and _whole(v) and 0 <= v < 2**64:
                return Constant(Decimal(v), UINT64)
            if tag == "Float" and (_whole(v) or isinstance(v, float)):
                return Constant(float(v), T.DoubleType())
            if tag == "Decimal" and isinstance(v, str):
                return _decimal_constant(v)
            if tag == "String" and isinstance(v, str):
                return Constant(v, T.StringType())
            if tag == "Bytes" and isinstance(v, (list, tuple, bytes)):
                return Constant(bytearray(v), T.BinaryType())
            if tag == "Date" and isinstance(v, str):
                return _date_constant(v)
        except (ArithmeticError, ValueError) as e:
            raise ConfigError(f"invalid tagged value {raw!r}: {e}") from e
        raise ConfigError(f"invalid tagged value {raw!r}")
    if raw is None:
        return Constant(None, null_type)
    if isinstance(raw, bool):
        return Constant(raw, T.BooleanType())
    if isinstance(raw, int):
        if -(2**63) <= raw < 2**63:
            return Constant(raw, T.LongType())
        if 0 <= raw < 2**64:
            return Constant(Decimal(raw), UINT64)
        return Constant(float(raw), T.DoubleType())
    if isinstance(raw, float):
        return Constant(raw, T.DoubleType())
    if isinstance(raw, str):
        return Constant(raw, T.StringType())
    # YAML turns unquoted dates into date objects.
    if isinstance(raw, dt.datetime):
        return Constant(raw.replace(tzinfo=None), T.TimestampNTZType())
    if isinstance(raw, dt.date):
        return Constant(raw, T.DateType())
    raise ConfigError(f"cannot use {raw!r} as a column value")


_MOMENT = re.compile(r"(\d{4}-\d{2}-\d{2})(?:[ T](\d{2}:\d{2}:\d{2})(?:\.(\d{1,6}))?)?")


def parse_moment(text: str) -> dt.datetime | None:
    """``YYYY-MM-DD[ HH:MM:SS[.ffffff]]`` as a datetime, None for anything else."""
    m = _MOMENT.fullmatch(text.strip())
    if m is None:
        return None
    try:
        moment = dt.datetime.fromisoformat(f"{m[1]} {m[2] or '00:00:00'}")
    except ValueError:
        return None
    return moment.replace(microsecond=int((m[3] or "0").ljust(6, "0")))


def instant(micros: int) -> dt.datetime:
    """Microseconds since 1970 as a moment in UTC."""
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=micros)


def lower_bound(dtype: T.DataType | None) -> Constant:
    """The mark of a first run: below the values of the type, so that ``> mark`` reads them.

    Zero and negative numbers, old dates and every text but the empty one are read.  What is
    the least of its type lies above no mark and is read by ``>=`` only: the least long,
    double and decimal of 38 digits, the first instant of year 1, the empty text.
    """
    if dtype is not None:
        kind = value_class(dtype)
        if kind == DATE:
            value = dt.date.min if isinstance(dtype, T.DateType) else dt.datetime.min
            return Constant(value, dtype)
        if kind in (TEXT, NULL):
            return Constant("", T.StringType())
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return Constant(-sys.float_info.max, T.DoubleType())
        if isinstance(dtype, T.DecimalType):
            whole = dtype.precision - dtype.scale
            if dtype.precision < 38:
                return Constant(Decimal(-(10**whole)), T.DecimalType(whole + 1, 0))
            return Constant(Decimal(1 - 10**whole), T.DecimalType(max(whole, 1), 0))
    return Constant(-(2**63), T.LongType())

