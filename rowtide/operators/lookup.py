"""Lookups into other tables, as joins instead of one query per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.operators.ranking import first_n
from rowtide.operators.steps import DEFAULT_TABLE, Branches, Step, StepContext, register_step

_BUCKET, _LANE, _DIM = "__bucket", "__lane", "__dim_"
_LEVEL = "__level"


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    columns: Sequence[str] | None = None,
    where: str | Column | None = None,
    params: Mapping[str, object] | None = None,
    limit: int | None = None,
    order: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Add the columns of the rows of ``dim`` whose ``on`` columns match.

    ``on`` maps columns of ``df`` to columns of ``dim``; ``where`` restricts ``dim``
    (SQL text, with ``params`` for its ``:names``); at most ``limit`` rows per key are
    taken, first in ``order``.  Both sides stay plain shuffles, so that a small ``dim``
    is broadcast and a skewed key of ``df`` is split by adaptive execution.
    """
    if not on:
        raise ConfigError("a lookup needs at least one key pair; see range_lookup for ranges")
    if how not in ("left", "inner"):
        raise ConfigError(f"lookup how={how!r}: 'left' or 'inner'")
    if where is not None:
        dim = restrict(dim, where, params)
    keys = list(on.values())
    wanted = list(columns) if columns else [c for c in dim.columns if c not in keys]
    clash = sorted(set(wanted) & set(df.columns))
    if clash:
        raise ConfigError(f"lookup columns {clash} exist already; rename them first")
    dim = dim.select(*[V.col(c) for c in dict.fromkeys([*keys, *wanted, *order])])
    if limit is not None:
        dim = first_n(dim, keys, limit, order)
    right = dim.select(*[V.col(k).alias(_DIM + k) for k in keys], *[V.col(c) for c in wanted])
    left, cond = df, [V.col(a) == V.col(_DIM + b) for a, b in on.items()]
    if limit is not None:
        # The ranking leaves ``dim`` partitioned by its key.  A second join column, always
        # zero on both sides, makes the join shuffle it anew: only then can adaptive
        # execution split a skewed key.
        zero = F.lit(1)
        right = right.withColumn(_DIM + _LANE, F.pmod(F.xxhash64(*[V.col(_DIM + k) for k in keys]), zero))
        left = df.withColumn(_LANE, F.pmod(F.xxhash64(*[V.col(a) for a in on]), zero))
        cond.append(F.col(_LANE) == F.col(_DIM + _LANE))
    joined = left.join(right, cond, how)
    return joined.select(*[V.col(c) for c in df.columns], *[V.col(c) for c in wanted])


def restrict(df: DataFrame, where: str | Column, params: Mapping[str, object] | None = None) -> DataFrame:
    """``df`` under a condition; SQL text binds its named parameters."""
    if isinstance(where, Column) or not params:
        return df.where(where)
    text = where.replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(f"SELECT * FROM {{df}} WHERE {text}", args=dict(params), df=df)


def cover(low: Column, high: Column) -> Column:
    """The fewest nodes (level, node) of the binary tree over whole numbers that make up ``low .. high``."""
    kind = "struct<low:bigint,high:bigint,nodes:array<struct<level:int,node:bigint>>>"

    def step(s: Column, level: Column) -> Column:
        lo, hi = s["low"], s["high"]
        first = (lo <= hi) & (lo.bitwiseAND(F.lit(1)) == 1)
        lo = lo + first.cast("bigint")
        last = (lo <= hi) & (hi.bitwiseAND(F.lit(1)) == 0)
        node = lambda n: F.array(F.struct(level.alias("level"), n.alias("node")))
        none = F.array().cast("array<struct<level:int,node:bigint>>")
        taken = F.concat(s["nodes"], F.when(first, node(s["low"])).otherwise(none), F.when(last, node(hi)).otherwise(none))
        hi = hi - last.cast("bigint")
        # What is used up stays so.
        left = lo <= hi
        return F.struct(
            F.when(left, F.shiftright(lo, 1)).otherwise(1).alias("low"), F.when(left, F.shiftright(hi, 1)).otherwise(0).alias("high"), taken.alias("nodes")
        ).cast(kind)

    begin = F.struct(low.alias("low"), high.alias("high"), F.array().cast("array<struct<level:int,node:bigint>>").alias("nodes")).cast(kind)
    whole = F.aggregate(F.sequence(F.lit(0), F.lit(63)), begin, step, lambda s: s["nodes"])
    return F.when(low <= high, whole)


def range_lookup(
    df: DataFrame,
    dim: DataFrame,
    point: str,
    low: Column,
    high: Column,
    width: float,
    columns: Sequence[str] | None = None,
    closed: tuple[bool, bool] = (True, True),
    how: str = "inner",
) -> DataFrame:
    """Rows of ``dim`` whose ``point`` lies between ``low`` and ``high`` of the left row.

    The point's axis is cut into buckets of ``width``, and pairs, fours, ... of buckets are the
    nodes of a binary tree.  A range is covered by few disjoint nodes, two a level at most however
    long it is; a point looks up its node at each level that some range uses.  So a pair meets once,
    and none is formed outside a common node.  ``width`` is best near the usual range length.
    Crowded nodes are split by adaptive execution.
    """
    if width <= 0:
        raise ConfigError("range_lookup: width must be positive")
    if how not in ("left", "inner"):
        raise ConfigError(f"range_lookup how={how!r}: 'left' or 'inner'")
    wanted = list(columns) if columns else dim.columns
    clash = sorted(set(wanted) & set(df.columns))
    if clash:
        raise ConfigError(f"lookup columns {clash} exist already; rename them first")
    names = [V.col(c) for c in df.columns]

    def bucket(c: Column) -> Column:
        return F.floor(c / F.lit(width)).cast("bigint")

    ends = df.select("*", low.alias("__low"), high.alias("__high"))
    left = ends.select("*", F.inline(cover(bucket(F.col("__low")), bucket(F.col("__high")))).alias(_LEVEL, _BUCKET))
    # At most one row for each level of the tree.
    nodes = df.select(low.alias("__low"), high.alias("__high")).select(F.inline(cover(bucket(F.col("__low")), bucket(F.col("__high")))))
    levels = sorted(r[0] for r in nodes.select("level").distinct().collect())
    at = F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))
    dims = dim.select(*[V.col(c) for c in wanted], V.col(point).alias("__point"), bucket(V.col(point)).alias("__bucket"), at.alias(_DIM + _LEVEL))
    right = dims.withColumn(_DIM + _BUCKET, F.call_function("shiftright", "__bucket", F.col(_DIM + _LEVEL))).drop("__bucket")
    p, lo, hi = F.col("__point"), F.col("__low"), F.col("__high")
    inside = (p >= lo if closed[0] else p > lo) & (p <= hi if closed[1] else p < hi)
    meet = (F.col(_BUCKET) == F.col(_DIM + _BUCKET)) & (F.col(_LEVEL) == F.col(_DIM + _LEVEL))
    matched = left.join(right, meet & inside)
    found = matched.select(*names, *[V.col(c) for c in wanted])
    if how == "inner":
        return found
    # A left row may span several nodes, so rows without a match are found apart.
    hit = matched.select(*[V.col(c).alias(_DIM + c) for c in df.columns]).distinct()
    same = [V.col(c).eqNullSafe(V.col(_DIM + c)) for c in df.columns]
    missed = df.join(hit, same, "left_anti")
    return found.unionByName(missed, allowMissingColumns=True)


def _config(raw: Any, step: str, needed: Sequence[str], known: Sequence[str]) -> dict[str, Any]:
    if not isinstance(raw, Mapping):
        raise ConfigError(f"{step}: the step is not configured")
    missing, unknown = [k for k in needed if not raw.get(k)], sorted(set(raw) - {*needed, *known})
    if missing or unknown:
        raise ConfigError(f"{step}: missing {missing}, unknown {unknown}")
    return dict(raw)


@register_step("lookup")
def _lookup_step(config: Any) -> Step:
    """Columns of another table by key; ``on`` maps columns of the rows to columns of the table."""
    known = ("connection", "columns", "where", "params", "limit", "order", "how")
    cfg = _config(config, "lookup", ("table", "on"), known)
    on, how = dict(cfg["on"]), cfg.get("how", "left")
    if how not in ("left", "inner"):
        raise ConfigError(f"lookup how={how!r}: 'left' or 'inner'")
    limit = cfg.get("limit")
    if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int) or limit < 1):
        raise ConfigError(f"lookup: bad limit {limit!r}")

    def run(ctx: StepContext, branches: Branches) -> Branches:
        df = branches[DEFAULT_TABLE]
        one = next(iter(on.items())) if len(on) == 1 else None
        dim = ctx.lookup_table(
            cfg.get("connection") or ctx.source_connection,
            cfg["table"],
            key=one[1] if one else None,
            keys=df.select(V.col(one[0])) if one else None,
            where=cfg.get("where"),
            params=cfg.get("params"),
        )
        return {**branches, DEFAULT_TABLE: lookup(df, dim, on, cfg.get("columns"), limit=limit, order=cfg.get("order") or (), how=how)}

    return run


@register_step("range_lookup")
def _range_lookup_step(config: Any) -> Step:
    """Rows of another table whose ``point`` lies between the columns ``low`` and ``high``."""
    needed = ("table", "point", "low", "high", "width")
    cfg = _config(config, "range_lookup", needed, ("connection", "columns", "where", "params", "closed", "how"))

    def run(ctx: StepContext, branches: Branches) -> Branches:
        df = branches[DEFAULT_TABLE]
        dim = ctx.lookup_table(cfg.get("connection") or ctx.source_connection, cfg["table"], where=cfg.get("where"), params=cfg.get("params"))
        found = range_lookup(
            df, dim, cfg["point"], V.col(cfg["low"]), V.col(cfg["high"]), cfg["width"], cfg.get("columns"),
            tuple(cfg.get("closed") or (True, True)), cfg.get("how", "inner"),
        )
        return {**branches, DEFAULT_TABLE: found}

    return run
