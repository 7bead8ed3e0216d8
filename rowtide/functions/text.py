"""Values as text, built from native expressions only."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V


def moment_text(c: Column, dtype: T.DataType) -> Column:
    """Shortest text of a date or timestamp.

    A midnight is a bare date, whole seconds have no fraction, anything else has
    six decimals.
    """
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    day = F.date_trunc("day", c).cast(dtype)
    second = F.date_trunc("second", c).cast(dtype)
    return (
        F.when(c == day, F.date_format(c, "yyyy-MM-dd"))
        .when(c == second, F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )


def float_text(c: Column) -> Column:
    """A floating number in plain notation: ``1.0`` is ``1``, ``1.5E7`` is ``15000000``.

    Spark writes large and small magnitudes as ``d.dddE±x``; the point is moved by
    ``x`` places here, so every finite value has its full decimal form.
    """
    own = c.cast("string")
    parts = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign, lead, tail, power = (F.regexp_extract(own, parts, i) for i in (1, 2, 3, 4))
    fraction = F.rtrim(tail, F.lit("0"))
    shift = power.try_cast("int")
    missing = shift - F.length(fraction)
    large = F.when(missing >= 0, F.concat(sign, lead, fraction, F.repeat(F.lit("0"), missing))).otherwise(
        F.concat(
            sign,
            lead,
            F.substring(fraction, F.lit(1), shift),
            F.lit("."),
            F.substring(fraction, shift + 1, F.length(fraction)),
        )
    )
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -shift - 1), lead, fraction)
    return (
        F.when(own.contains("E"), F.when(shift >= 0, large).otherwise(small))
        .when(own.endswith(".0"), F.substring(own, F.lit(1), F.length(own) - 2))
        .when(own.endswith("Infinity"), F.replace(own, F.lit("Infinity"), F.lit("inf")))
        .otherwise(own)
    )


def display_text(c: Column, dtype: T.DataType) -> Column:
    """The text a value turns into when a column is cast to text."""
    kind = V.value_class(dtype)
    if kind == V.DATE:
        return moment_text(c, dtype)
    if kind == V.BYTES:
        return F.concat(F.lit("0x"), F.hex(c))
    if V.is_floating(dtype):
        return float_text(c)
    return c.cast("string")


def compare_text(c: Column, dtype: T.DataType) -> Column:
    """What ``c`` counts as in a text comparison; never null.

    Text, decimals and dates count as their text; null, plain numbers, booleans
    and bytes count as the empty text.
    """
    kind = V.value_class(dtype)
    if kind in (V.TEXT, V.DATE) or isinstance(dtype, T.DecimalType):
        return F.coalesce(display_text(c, dtype), F.lit(""))
    return F.lit("")


def time_text(seconds: Column) -> Column:
    """A duration in seconds as ``HH:MM:SS``, days folded into the hours."""
    whole = F.abs(seconds).cast("bigint")
    sign = F.when(seconds < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(
        seconds.isNotNull(),
        F.concat(
            sign,
            F.format_string(
                "%02d:%02d:%02d",
                F.floor(whole / 3600),
                F.floor(F.pmod(whole, F.lit(3600)) / 60),
                F.pmod(whole, F.lit(60)),
            ),
        ),
    )


def literal_text(value: Any) -> str:
    """A value as a SQL literal, for logs only; queries bind their values."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "1" if value else "0"
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() and abs(value) < 1e16 else repr(value)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex().upper()}'"
    if isinstance(value, Decimal):
        value = format(value, "f")
    elif isinstance(value, dt.datetime):
        value = python_moment_text(value)
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return "'" + str(value).replace("'", "''") + "'"


def python_moment_text(moment: dt.datetime) -> str:
    """Shortest text of one datetime, as :func:`moment_text` gives for columns."""
    moment = moment.replace(tzinfo=None)
    if moment.time() == dt.time():
        return moment.date().isoformat()
    return moment.isoformat(" ", "microseconds" if moment.microsecond else "seconds")
