"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: every step replaces edges by edges towards the
least neighbour, with one aggregation (which combines before the shuffle) and one join (which
adaptive execution can split at a hot vertex).  The number of edges never grows.  Each step's
edges are written to the shared folder, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import Scratch, forget, stored

#: Edges to a file between steps.
FILE_EDGES = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").where("b <> m").select(F.col("m").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` have a < b; every b keeps its least a, and its other neighbours are joined to that."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    rest = edges.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return rest.unionByName(least.select(F.col("m").alias("a"), "b")).distinct()


def components(edges: DataFrame, tasks: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """(id, component_id) of every id in ``edges`` (a, b: long); component_id is the least id connected.

    ``tasks``: for reading ``edges``, where few are known to come.  ``scratch`` takes over what the
    result is read from.  Edges may repeat, stand in either direction or join an id to itself; rows with nulls are
    ignored.  Ids that no edge names have no row.
    """
    at = edges.where("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    now = stored(at.distinct(), "edges", tasks)

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    before = state(now)
    while before[0]:
        after = stored(_small_star(_large_star(now)), "edges", 1 + before[0] // FILE_EDGES)
        forget(now)
        now, then = after, state(after)
        if then == before:
            break
        before = then
    if scratch is not None:
        scratch.made.append(now)
    return now.select(F.col("b").alias("id"), F.col("a").alias("component_id")).unionByName(
        now.select(F.col("a").alias("id"), F.col("a").alias("component_id")).distinct()
    )
