"""Size bounds, asked before anything is broadcast."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_GROWING = re.compile(r"^[\s:+|-]*(Generate|Expand|Range|Map\w*|FlatMap\w*|ScriptTransformation)\b", re.MULTILINE)
# Compressed bytes say little about rows: where rows are counted, this bounds them too.
BROADCAST_ROWS = 5_000_000
# What Spark assumes for an input of unknown size.
_UNKNOWN = 2**63 - 1
_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30, "t": 2**40, "tb": 2**40}


def to_bytes(text: str) -> int:
    """A size setting (``10485760``, ``128MB``, ``10485760b``) in bytes."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", str(text).strip().lower()).groups()
    return int(number) * _UNITS[unit]


def broadcast_threshold(spark: SparkSession) -> int:
    """The session's own limit in bytes; -1 switches broadcasting off."""
    return to_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate.

    Without table statistics filters do not reduce it, so for scans, projections and
    filters it is bound by the size of the files read.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scan_bytes(df: DataFrame) -> int | None:
    """Bytes of all inputs together; None if one of them does not know its size."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if any(s >= _UNKNOWN for s in sizes) else sum(sizes)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is known to stay under the broadcast threshold.

    Operators that can make many rows of one (explode, Python code) void the estimate.
    """
    if _GROWING.search(df._jdf.queryExecution().optimizedPlan().toString()):
        return False
    return plan_bytes(df) <= broadcast_threshold(df.sparkSession)
