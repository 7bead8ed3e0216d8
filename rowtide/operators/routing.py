"""Spreading rows over writers: by key hash, or evenly."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide import types as V
from rowtide.operators.steps import TABLE_TAG, Branches
from rowtide.errors import ConfigError


def bucket_of(keys: Sequence[str], n: int) -> Column:
    """The bucket 0..n-1 of a key: equal keys, equal bucket."""
    if n < 1:
        raise ConfigError("at least one bucket is needed")
    return F.pmod(F.xxhash64(*[V.col(k) for k in keys]), F.lit(n)).cast("int")


def fan_out(df: DataFrame, tables: Sequence[str], tag: str = TABLE_TAG) -> Branches:
    """One frame per table, for rows that carry their table's name in ``tag``."""
    rest = [V.col(c) for c in df.columns if c != tag]
    return {t: df.where(V.col(tag) == t).select(*rest) for t in tables}


def tagged_counts(df: DataFrame, tag: str = TABLE_TAG) -> DataFrame:
    """Rows per target table of rows that carry their table's name, in one pass."""
    return df.groupBy(V.col(tag).alias("target_table")).agg(F.count(F.lit(1)).alias("n"))


def table_counts(branches: Branches) -> DataFrame:
    """Rows per target table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("target_table"), "n")
        for t, df in branches.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def route(df: DataFrame, writers: int, keys: Sequence[str] = ()) -> DataFrame:
    """``df`` in ``writers`` partitions: rows of one key together, or evenly without keys.

    Keys are meant to be (nearly) unique, as those of an upsert are.
    """
    if writers < 1:
        raise ConfigError("at least one writer is needed")
    if keys:
        return df.repartition(writers, *[V.col(k) for k in keys])
    return df.repartition(writers)
