"""Header/detail split: one input row becomes a header row and its detail rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.operators.mapping import keep_columns
from rowtide.operators.ranking import first_n
from rowtide.operators.steps import DEFAULT_TABLE, Branches, Step, StepContext, merge_branches, register_step
from rowtide.plans.sizing import BROADCAST_ROWS, fits_broadcast

# A parent repeated more often than this is spread over tasks before it is multiplied.
HEAVY_PARENT = 1000
_PARENT, _COPIES = "__parent", "__copies"


@dataclass(frozen=True)
class SplitConfig:
    """``limit`` is the most detail rows taken per parent, first in ``order``; None takes all."""

    detail_table: str
    parent_key: str
    source_detail_table: str = ""
    detail_columns: tuple[str, ...] = ()
    child_key: str = ""
    keep: tuple[str, ...] = ()
    limit: int | None = None
    order: tuple[str, ...] = ()

    @staticmethod
    def parse(raw: Any) -> SplitConfig:
        if not isinstance(raw, Mapping):
            raise ConfigError("order_split: the step is not configured")
        for required in ("detail_table", "parent_key"):
            if not isinstance(raw.get(required), str) or not raw[required].strip():
                raise ConfigError(f"order_split: {required} is required")
        limit = raw.get("limit")
        if limit is not None and (isinstance(limit, bool) or not isinstance(limit, int) or limit < 0):
            raise ConfigError(f"order_split: bad limit {limit!r}")
        lists = {k: tuple(raw.get(k) or ()) for k in ("detail_columns", "keep", "order")}
        return SplitConfig(
            detail_table=raw["detail_table"],
            parent_key=raw["parent_key"],
            source_detail_table=raw.get("source_detail_table") or raw["detail_table"],
            child_key=raw.get("child_key") or raw["parent_key"],
            limit=limit,
            **lists,
        )


def split_headers(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The header rows: every input row, reduced to ``keep``."""
    return keep_columns(df, keep)


def split_details(
    parents: DataFrame,
    details: DataFrame,
    parent_key: str,
    child_key: str,
    columns: Sequence[str] = (),
    limit: int | None = None,
    order: Sequence[str] = (),
    unique_parents: bool = False,
    rows: int | None = None,
) -> DataFrame:
    """The detail rows of ``parents``: all, or at most ``limit`` per parent row.

    Detail rows carry only detail columns.  A null parent has none, a repeated parent
    repeats its rows.  The limit is applied to the details before the join, where it
    also bounds what a crowded key ships.

    ``unique_parents`` says that parents hardly repeat: the result is the same, without
    the step that counts repeated parents beforehand.  ``rows`` is the number of parents,
    if it is known.
    """
    wanted = list(columns) or details.columns
    if limit == 0:
        return details.where(F.lit(False)).select(*[V.col(c) for c in wanted])
    needed = list(dict.fromkeys([child_key, *wanted, *order]))
    details = details.select(*[V.col(c) for c in needed])
    keys = parents.select(V.col(parent_key).alias(_PARENT)).where(F.col(_PARENT).isNotNull())
    if limit is not None:
        if (rows is None or rows <= BROADCAST_ROWS) and fits_broadcast(keys):
            # Few parents: rank only the details that can be wanted.
            details = details.join(F.broadcast(keys), V.col(child_key) == F.col(_PARENT), "left_semi")
        details = first_n(details, [child_key], limit, order)
    out = [V.col(c) for c in wanted]
    on = V.col(child_key) == F.col(_PARENT)
    if unique_parents or limit is None:
        # Without a ranking both sides are plain shuffles, so adaptive execution splits a
        # key that is crowded on either side.
        return details.join(keys, on).select(*out)
    # Repeated parents are counted first (combined before the shuffle), and their details
    # multiplied after the join; the join itself meets every parent once.
    counted = keys.groupBy(_PARENT).agg(F.count(F.lit(1)).alias(_COPIES))
    light = details.join(counted.where(F.col(_COPIES) <= HEAVY_PARENT), on)
    light = light.select(*out, F.explode(F.sequence(F.lit(1), F.col(_COPIES))).alias("__n")).select(*out)
    heavy = details.join(counted.where(F.col(_COPIES) > HEAVY_PARENT), on)
    return light.unionAll(_multiplied(heavy, wanted))


def _multiplied(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Every row ``__copies`` times: first as blocks, which are spread, then one by one."""
    out = [V.col(c) for c in wanted]
    # Blocks near the square root of the count keep both arrays short.
    size = F.ceil(F.sqrt(F.col(_COPIES))).cast("bigint")
    blocks = df.select(
        *out,
        F.col(_COPIES),
        size.alias("__size"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(_COPIES) - 1) / size))).alias("__block"),
    )
    left = F.least(F.col("__size"), F.col(_COPIES) - F.col("__block") * F.col("__size"))
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = blocks.repartition(n)
    return spread.select(*out, F.explode(F.sequence(F.lit(1).cast("bigint"), left)).alias("__n")).select(*out)


@register_step("order_split")
def order_split(config: Any) -> Step:
    """Headers stay on the default branch, details go to ``detail_table``."""
    cfg = SplitConfig.parse(config)

    def run(ctx: StepContext, branches: Branches) -> Branches:
        parents = branches[DEFAULT_TABLE]
        headers = split_headers(parents, cfg.keep)
        if V.column_type(parents, cfg.parent_key) is None:
            return {**branches, DEFAULT_TABLE: headers}
        columns = dict.fromkeys([cfg.child_key, *cfg.detail_columns, *cfg.order]) if cfg.detail_columns else ()
        details = split_details(
            parents,
            ctx.lookup_table(
                ctx.source_connection,
                cfg.source_detail_table,
                tuple(columns),
                key=cfg.child_key,
                keys=parents.select(V.col(cfg.parent_key)),
            ),
            cfg.parent_key,
            cfg.child_key,
            cfg.detail_columns,
            cfg.limit,
            cfg.order,
            unique_parents=ctx.unique_key == (cfg.parent_key,),
            rows=ctx.rows,
        )
        return merge_branches({**branches, DEFAULT_TABLE: headers}, {cfg.detail_table: details})

    return run
