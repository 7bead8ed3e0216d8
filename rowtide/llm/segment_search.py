"""Exact top-k search by inner product, with multi-resolution segment statistics.

A vector is cut into segments; for each its mean and its deviation are kept.  With segments of
length n, the squared distance of two vectors is at least the sum of n * ((difference of means) ** 2
+ (difference of deviations) ** 2), so that their inner product, (|a| ** 2 + |b| ** 2 - distance) / 2,
is at most the sum of n * (product of means + product of deviations).  More segments give a closer
bound at more cost.

1. Of equal vectors only the k + 1 least ids can ever be answered, so only these are candidates;
   equal queries are asked once.
2. Candidates and queries are dealt into blocks of bounded size by the signs of their segment means.
3. Each block of queries meets the candidates of its own signs first; the (k + 1)-th score there is
   a query's first cut.
4. Of all other pairs of blocks those are left out whose boxes of statistics stay below every cut.
5. Inside a pair of blocks, bounds with 1, 4 and 16 segments thin out the pairs of vectors, and exact
   scores are computed for survivors.  A block gives at most k + 1 rows for a query, and more among equal scores.

Components are floor(scale * x) in 64 bits.  Null and empty vectors and those with null or
non-finite components take no part, nor do rows with a null id, nor vectors whose squared length
passes 2 ** 63, where scores would.  Vectors of different lengths do not meet.
Rows that repeat an id are rows of their own: each is a query and, for other rows, a candidate.
Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import forget, stored, table

#: Candidates and queries of a block.
CANDIDATES = 2048
QUERIES = 1024
#: Segments of the statistics that deal vectors into blocks and bound whole blocks.
COARSE = 8
#: Segments of the bounds inside a pair of blocks, coarse to fine.
LEVELS = (1, 4, 16)
#: Blocks of candidates that a block of queries meets at once.
TOGETHER = 512
LOWEST = np.iinfo(np.int64).min


def segments(dims: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """First component and length of at most ``count`` segments of nearly equal length."""
    ends = np.unique(np.arange(1, count + 1) * dims // count)
    ends = ends[ends > 0]
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)[: len(ends)]
    return starts, ends - starts


def statistics(x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means and deviations of the segments of each row, and the segments' lengths."""
    starts, lengths = segments(x.shape[1], count)
    if not len(starts):
        return np.zeros((len(x), 0)), np.zeros((len(x), 0)), lengths
    x = x.astype(np.float64)
    mean = np.add.reduceat(x, starts, axis=1) / lengths
    apart = x - np.repeat(mean, lengths, axis=1)
    return mean, np.sqrt(np.add.reduceat(apart * apart, starts, axis=1) / lengths), lengths


def features(x: np.ndarray, count: int) -> np.ndarray:
    """Rows whose inner products are the bounds with ``count`` segments."""
    mean, deviation, lengths = statistics(x, count)
    return np.concatenate([mean * np.sqrt(lengths), deviation * np.sqrt(lengths)], axis=1)


def slack(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """What rounding may take from a bound."""
    norm = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
    return 1e-6 + 1e-9 * norm(q)[:, None] * norm(c)[None, :]


def scores(q: np.ndarray, c: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact inner products, and which of them can reach the cuts of their queries."""
    alive = np.ones((len(q), len(c)), bool)
    room = slack(q, c)
    for count in LEVELS:
        if count > 1 and 2 * count > q.shape[1]:
            break
        alive &= features(q, count) @ features(c, count).T + room >= cut[:, None].astype(np.float64)
    out = np.full(alive.shape, LOWEST, np.int64)
    i, j = np.nonzero(alive)
    if len(i) > 0.2 * alive.size:
        # Whole numbers below 2 ** 53 are exact in double precision, and faster.
        small = len(q) and len(c) and float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1] < 2.0**53
        every = (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64) if small else q @ c.T
        out[alive] = every[alive]
    else:
        for s in range(0, len(i), 100_000):
            a, b = i[s : s + 100_000], j[s : s + 100_000]
            out[a, b] = (q[a] * c[b]).sum(axis=1)
    return out, alive & (out >= cut[:, None])


def prepared(vectors: DataFrame, id_column: str, column: str, scale: float) -> DataFrame:
    """id, dims, vec (64-bit numbers as bytes), mean and deviation of COARSE segments; only rows that take part."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, dims, means, deviations = [], [], [], [], []
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                if i is None or not v or None in v:
                    continue
                x = np.floor(scale * np.array(v, np.float64))
                if not np.isfinite(x).all() or not (x * x).sum() < 2.0**63:
                    continue
                mean, deviation, _ = statistics(x[None, :], COARSE)
                ids.append(i)
                dims.append(len(x))
                out.append(x.astype(np.int64).tobytes())
                means.append(mean[0])
                deviations.append(deviation[0])
            numbers = pa.list_(pa.float64())
            columns = pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary()), pa.array(means, numbers), pa.array(deviations, numbers)
            yield pa.RecordBatch.from_arrays(list(columns), names=["id", "dims", "vec", "mean", "deviation"])

    named = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(column).alias("v"))
    return named.mapInArrow(pack, "id long, dims int, vec binary, mean array<double>, deviation array<double>")


def dealt(rows: DataFrame, bits: int, size: int, key: str) -> DataFrame:
    """``rows`` with their signs and a block of about ``size`` rows of equal signs and length."""
    signs = F.lit(0)
    for b in range(bits):
        signs = signs + F.when(F.get("mean", F.lit(b)) > 0, F.lit(1 << b)).otherwise(F.lit(0))
    signed = rows.withColumn("signs", signs)
    counts = signed.groupBy("dims", "signs").agg(F.ceil(F.count("*") / size).alias("parts"))
    part = F.pmod(F.xxhash64(key), F.col("parts")).cast("int")
    return signed.join(counts, ["dims", "signs"]).withColumn("part", part).withColumn("block", F.struct("dims", "signs", "part")).drop("parts", "part")


def boxes(rows: DataFrame, *more: Column) -> DataFrame:
    """For each block the least and largest mean, and the largest deviation, of each coarse segment."""
    each = [F.struct(F.min(F.get("mean", F.lit(i))).alias("low"), F.max(F.get("mean", F.lit(i))).alias("high"), F.max(F.get("deviation", F.lit(i))).alias("deviation")) for i in range(COARSE)]
    return rows.groupBy("block", "dims", "signs").agg(F.array(*each).alias("box"), *more)


def bound(a: Column, b: Column, dims: Column) -> Column:
    """What inner products between two boxes cannot pass; a segment is never longer than dims / COARSE + 1."""

    def segment(x: Column, y: Column) -> Column:
        corners = F.greatest(*[x[i] * y[j] for i in ("low", "high") for j in ("low", "high")])
        return F.coalesce(F.greatest(corners + x["deviation"] * y["deviation"], F.lit(0.0)), F.lit(0.0))

    longest = F.floor(dims / COARSE) + 1
    return F.aggregate(F.zip_with(a, b, segment), F.lit(0.0), lambda s, x: s + x) * longest * (1 + 1e-9) + 1e-6


def met(pairs: DataFrame, asked: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """q, score, id, row: for the pairs (own, block), the best of each query that reach its cut."""

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        made = {"q": [], "score": [], "id": [], "row": []}
        if left.num_rows and right.num_rows:
            x = [np.frombuffer(b"".join(t["vec"].to_pylist()), np.int64).reshape(t.num_rows, -1) for t in (left, right)]
            cut = left["cut"].to_numpy().copy()
            exact, alive = scores(x[0], x[1], cut)
            if right.num_rows > k + 1:
                kth = np.partition(exact, right.num_rows - k - 1, axis=1)[:, right.num_rows - k - 1]
                alive &= exact >= kth[:, None]
            i, j = np.nonzero(alive)
            made = {"q": left["q"].to_numpy()[i], "score": exact[i, j], "id": right["id"].to_numpy()[j], "row": right["row"].to_numpy()[j]}
        return pa.table({c: pa.array(np.asarray(v, np.int64)) for c, v in made.items()})

    left = asked.select(F.col("block").alias("own"), "q", "vec", "cut").join(pairs, "own").groupBy("own", "block")
    right = candidates.select("block", "id", "row", "vec").join(pairs, "block").groupBy("own", "block")
    return left.cogroup(right).applyInArrow(compare, "q long, score long, id long, row long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 best of each query, numbered."""
    by = Window.partitionBy("q").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= k + 1)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row whose ``id`` fits ``is_query`` (over column id)."""
    every = stored(prepared(vectors, id_column, column, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    first = F.row_number().over(Window.partitionBy("vec", "dims").orderBy("id", "row"))
    distinct = every.withColumn("copy", first).where(F.col("copy") <= k + 1).drop("copy")
    n = every.count()
    bits = min(COARSE, max(0, round(math.log2(max(1, n / CANDIDATES)))))
    candidates = stored(dealt(distinct, bits, CANDIDATES, "row"), "candidates")
    queries = stored(every.where(is_query), "queries")
    unlike = queries.groupBy("vec", "dims").agg(F.min("row").alias("q"), F.first("mean").alias("mean"), F.first("deviation").alias("deviation"))
    fewer = min(bits, max(0, round(math.log2(max(1, queries.count() / QUERIES)))))
    asked = stored(dealt(unlike, fewer, QUERIES, "q"), "asked")
    # Blocks of queries look at fewer signs; one block of candidates with the same ones is their first.
    like = F.col("signs").bitwiseAND(F.lit((1 << fewer) - 1)).alias("signs")
    first_blocks = candidates.groupBy("dims", like).agg(F.min("block").alias("block"))
    home = stored(asked.select(F.col("block").alias("own"), "dims", "signs").distinct().join(first_blocks, ["dims", "signs"]).select("own", "block"), "home")
    seeds = stored(best(met(home, asked.withColumn("cut", F.lit(LOWEST)), candidates, k), k), "seeds")
    cuts = seeds.where(F.col("place") == k + 1).select("q", F.col("score").alias("cut"))
    cut_asked = stored(asked.join(cuts, "q", "left").withColumn("cut", F.coalesce("cut", F.lit(LOWEST))), "cut")
    theirs = stored(boxes(candidates), "boxes")
    groups = max(1, -(-theirs.count() // TOGETHER))
    theirs = theirs.select("block", "dims", F.col("box").alias("other"), F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("group"))
    ours = boxes(cut_asked, F.min("cut").alias("cut")).select(
        F.col("block").alias("own"), "dims", "box", "cut", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    )
    reached = ours.join(theirs, ["dims", "group"]).where(bound(F.col("box"), F.col("other"), F.col("dims")) >= F.col("cut"))
    pairs = stored(reached.select("own", "block").join(home, ["own", "block"], "left_anti"), "pairs")
    found = seeds.drop("place").unionByName(met(pairs, cut_asked, candidates, k))
    answers = best(found, k).select("q", "score", F.col("id").alias("vec_id"), F.col("row").alias("other"), "place")
    rows = queries.select("id", "row", "vec", "dims").join(asked.select("q", "vec", "dims"), ["vec", "dims"]).select("q", F.col("id").alias("query_id"), "row")
    rank = F.row_number().over(Window.partitionBy("row").orderBy("place"))
    others = rows.join(answers, "q").where(F.col("row") != F.col("other")).withColumn("rank", rank).where(F.col("rank") <= k)
    out = stored(others.select("query_id", "rank", "vec_id", "score"), "nearest")
    for made in (every, candidates, queries, asked, home, seeds, cut_asked, pairs):
        forget(made)
    return out


def op11_segment_search(spark, sf_dir: str) -> DataFrame:
    """The twenty best partners of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
u AS (SELECT row, vec_id, len(e) AS n, unnest(e) AS x, unnest(range(len(e))) AS i FROM v),
s AS (
  SELECT q.row AS own, q.vec_id AS query_id, c.row, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM u q JOIN u c ON q.i = c.i AND q.n = c.n AND q.row <> c.row WHERE q.vec_id % 20 = 0 GROUP BY ALL)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id, row) AS INT) AS rank FROM s) WHERE rank <= 20
"""
