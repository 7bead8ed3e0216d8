"""Column lists: mapping source names to target names, keeping, padding."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide import types as V
from rowtide.errors import ConfigError


def _or_null(df: DataFrame, name: str, null_type: str) -> Column:
    if V.column_type(df, name) is None:
        return F.lit(None).cast(null_type)
    return V.col(name)


def map_columns(
    df: DataFrame,
    source: Sequence[str] = (),
    target: Sequence[str] = (),
    null_type: str = "string",
) -> DataFrame:
    """Project ``df`` to the columns of a target.

    With both lists, ``target[i]`` takes the value of ``source[i]`` for as many pairs
    as the shorter list has; a repeated target keeps its last value.  With one list,
    those names are kept.  With none, the frame is returned unchanged.  A listed name
    that the frame lacks becomes a null of ``null_type``.
    """
    if not source and not target:
        return df
    if source and target:
        pairs = dict(zip(target, source, strict=False))
    else:
        pairs = {name: name for name in (source or target)}
    return df.select(*[_or_null(df, s, null_type).alias(t) for t, s in pairs.items()])


def project(df: DataFrame, names: Sequence[str], null_type: str = "string") -> DataFrame:
    """``names`` in the given order, nulls for missing ones."""
    return df.select(*[_or_null(df, n, null_type).alias(n) for n in names])


def keep_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The listed columns that exist; an empty list keeps all."""
    if not keep:
        return df
    return df.select(*[V.col(c) for c in keep if V.column_type(df, c) is not None])


def union_normalised(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of unlike frames: all columns of all frames, null where one lacks them."""
    if not frames:
        raise ConfigError("nothing to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
