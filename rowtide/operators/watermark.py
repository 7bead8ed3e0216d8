"""High-water marks: the largest value seen of a column, which only moves up."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError


def mark_aggregates(df: DataFrame, specs: Mapping[str, str]) -> list[Column]:
    """One ``max`` per mark; ``specs`` maps the mark's name to its column.

    They fit ``df.agg`` as well as ``df.observe``, which gets them from the pass that
    writes the rows.
    """
    out = []
    for key, column in specs.items():
        dtype = V.column_type(df, column)
        if dtype is None:
            raise ConfigError(f"state {key!r}: no column {column!r} in the source")
        if V.value_class(dtype) not in (V.NUMBER, V.TEXT, V.DATE):
            raise ConfigError(f"state {key!r}: a {dtype.simpleString()} column has no order to track")
        out.append(F.max(V.col(column)).alias(key))
    return out


def max_marks(df: DataFrame, specs: Mapping[str, str]) -> DataFrame:
    """One row with the maximum of every tracked column."""
    return df.agg(*mark_aggregates(df, specs))


def read_marks(df: DataFrame, specs: Mapping[str, str]) -> tuple[int, dict[str, V.Constant]]:
    """Row count and maxima, from one scan of the tracked columns; one row comes back."""
    types = {key: V.column_type(df, column) for key, column in specs.items()}
    maxima = mark_aggregates(df, specs)
    # Instants come as numbers: local time would name two of them when clocks are set back.
    instant = [isinstance(t, T.TimestampType) for t in types.values()]
    sent = [F.unix_micros(m).alias(k) if i else m for k, m, i in zip(specs, maxima, instant, strict=True)]
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *sent).first()
    values = [V.instant(row[k]) if i and row[k] is not None else row[k] for k, i in zip(specs, instant, strict=True)]
    return row["__rows"], {k: V.Constant(v, types[k]) for k, v in zip(specs, values, strict=True)}


def advanced(old: Any, new: Any) -> Any:
    """The mark after a run; values of different kinds never replace each other."""
    if new is None:
        return old
    if old is None:
        return new
    try:
        return new if new > old else old
    except TypeError:
        return old


def advance_column(old: Any, new: Column, dtype: T.DataType) -> Column:
    """The same within a plan."""
    return F.greatest(F.lit(old).cast(dtype), new)
