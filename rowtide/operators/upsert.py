"""Keyed merge of new rows into a table, as joins.

``merge`` gives the table after the upsert; ``inserts`` and ``updates`` are its two
halves.  Source rows must be unique by key: see :func:`rowtide.operators.ranking.dedup_last`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.plans.sizing import fits_broadcast

_SRC, _HIT, _SALT = "__src_", "__hit", "__salt"


def _check(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> list[str]:
    """The non-key columns that the source brings."""
    if not keys:
        raise ConfigError("an upsert needs key columns")
    for side, df in (("target", target), ("source", source)):
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ConfigError(f"upsert: {side} lacks key column(s) {missing}")
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ConfigError(f"upsert: target has no column(s) {unknown}")
    return [c for c in source.columns if c not in keys]


def _renamed(source: DataFrame) -> DataFrame:
    return source.select(*[V.col(c).alias(_SRC + c) for c in source.columns])


def _match(keys: Sequence[str]):
    # A null key never matches, as in a database.
    return [V.col(k) == V.col(_SRC + k) for k in keys]


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with a salt that is 0, or for rows without a key, which match nothing, a hash of the row."""
    missing = V.col(keys[0]).isNull()
    for k in keys[1:]:
        missing = missing | V.col(k).isNull()
    plain = [V.col(f.name) for f in df.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    # Zero, but no constant, which the optimizer would take out of the join's keys.
    zero = F.pmod(F.xxhash64(*[V.col(k) for k in keys]), F.lit(1).cast("long"))
    return df.withColumn(_SALT, F.when(missing, F.xxhash64(*plain)).otherwise(zero))


def merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], small_source: bool | None = None
) -> DataFrame:
    """``target`` after the upsert of ``source``.

    Matched rows take the non-key columns that the source has; new rows get nulls in the
    columns it lacks.  Source values are cast to the target's types.

    With a ``small_source`` the target is never shuffled: the source is broadcast to it,
    and new rows are found against the matched keys.  Otherwise both sides meet in one
    full outer join, where rows without a key are dealt over all tasks.  None decides by
    the source's size bound.
    """
    values = _check(target, source, keys)
    source = source.select(
        *[V.col(c).cast(V.column_type(target, c)).alias(c) for c in source.columns]
    )
    if small_source is None:
        small_source = fits_broadcast(source)
    if not values:
        return target.unionByName(inserts(target, source, keys, small_source), allowMissingColumns=True)
    right = _renamed(source).withColumn(_HIT, F.lit(True))
    if small_source:
        hit = F.col(_HIT).isNotNull()
        merged = target.join(F.broadcast(right), _match(keys), "left").select(
            *[
                F.when(hit, V.col(_SRC + c)).otherwise(V.col(c)).alias(c) if c in values else V.col(c)
                for c in target.columns
            ]
        )
        return merged.unionByName(inserts(target, source, keys, True), allowMissingColumns=True)
    hit = F.col(_HIT).isNotNull()
    columns = []
    for c in target.columns:
        if c in values:
            columns.append(F.when(hit, V.col(_SRC + c)).otherwise(V.col(c)).alias(c))
        elif c in keys:
            columns.append(F.coalesce(V.col(c), V.col(_SRC + c)).alias(c))
        else:
            columns.append(V.col(c))
    left, right = _spread(target, keys), _spread(right, [_SRC + k for k in keys]).withColumnRenamed(_SALT, _SRC + _SALT)
    return left.join(right, [*_match(keys), V.col(_SALT) == V.col(_SRC + _SALT)], "full_outer").select(*columns)


def inserts(
    target: DataFrame, source: DataFrame, keys: Sequence[str], small_source: bool | None = None
) -> DataFrame:
    """Source rows whose key the target does not have."""
    _check(target, source, keys)
    if small_source is None:
        small_source = fits_broadcast(source)
    known = target.select(*[V.col(k).alias(_SRC + k) for k in keys])
    if small_source:
        # Reduce the target's keys to those of the source first: that side is small too.
        wanted = source.select(*[V.col(k).alias(_SRC + "w_" + k) for k in keys])
        known = known.join(
            F.broadcast(wanted), [V.col(_SRC + k) == V.col(_SRC + "w_" + k) for k in keys], "left_semi"
        )
    return source.join(known, _match(keys), "left_anti")


def updates(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key exists with at least one different value."""
    values = _check(target, source, keys)
    old = target.select(*[V.col(c).alias(_SRC + c) for c in (*keys, *values)])
    joined = source.join(old, _match(keys))
    if not values:
        return joined.where(F.lit(False)).select(*[V.col(c) for c in source.columns])
    same = [V.col(c).eqNullSafe(V.col(_SRC + c)) for c in values]
    changed = ~same[0]
    for s in same[1:]:
        changed = changed | ~s
    return joined.where(changed).select(*[V.col(c) for c in source.columns])
