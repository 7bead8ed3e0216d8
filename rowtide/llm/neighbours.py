"""Near-duplicate vectors by NN-descent.

1. Equal vectors become one node with a number of copies.
2. *First graph.*  Sign codes of random hyperplanes deal the nodes into small groups, several
   times; inside a group every node takes its nearest k.  A crowded group is split at random.
3. *Descent.*  Neighbours of a node (in either direction, in parts of bounded size) are
   compared with each other; each keeps its nearest k.  A part without a new neighbour is
   skipped.  Rounds end when few lists change.
   A list keeps k of the links a comparison meets.  So that no link is lost to k nearer ones,
   each comparison also gives a spanning forest of all its pairs above the threshold, which is
   kept beside the lists: what was met stays connected, at less than one edge per compared node.
4. *Threshold edges* of lists and forests give components.  The links of a node are counted
   among all members of its component, compared in blocks, so their number is exact within the
   component and no list of all pairs is written.
5. *Audit.*  Nodes drawn by hash are compared with all nodes, in blocks, until enough of them
   have links (``AUDITS`` bounds the draw).  Recall is a mean over nodes, taken apart for those
   with few and with many links, so a hot group does not speak for small ones.  Links it finds
   beyond the graph join the graph; if a recall falls short, more tables and descent follow,
   and when these bring no gain any more the run fails.  If the largest draw holds no linked
   node, all attempts are made, and nothing is known about recall.

The number of tables follows the length of the codes, so that a pair at the threshold shares a
group in some table equally often at every size.

Vectors stay in Spark; to the driver come counts and the audit sample, both bounded.

Vectors that are null, zero, or hold null or non-finite components link with nothing, as do
rows with a null id, whose component is null and which are not kept.  Every row has a row, and is a vector
of its own: rows that repeat an id link by their vectors alone, and equal rows link with each other.  Vectors of different lengths do not link.  Extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import stored, table
from rowtide.llm.components import components

K = 8
TABLES = 10
#: Chance that a pair at the threshold shares a code in no table.
MISSED = 6e-4
GROUP = 256
CROWDED = 1024
PART = 64
BLOCK = 256
#: Nodes drawn for the audit, until ENOUGH of them have from one to k links.
AUDITS = (256, 1024, 4096)
ENOUGH = 64
EDGES = "a long, b long, sim double"
LISTS = EDGES + ", link boolean"


def unit(raw: list[bytes]) -> np.ndarray:
    """Rows of unit length, in double precision."""
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def prepared(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """id, dims, vec (doubles as bytes, null if the vector cannot link)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, dims = batch.column("id").to_pylist(), [], []
            for i, v in zip(ids, batch.column("v").to_pylist(), strict=True):
                x = np.array([np.nan if c is None else c for c in v or []], np.float64) + 0.0
                good = i is not None and len(x) and np.isfinite(x).all() and x.any()
                out.append(x.tobytes() if good else None)
                dims.append(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(out, pa.binary())], names=["id", "dims", "vec"])

    named = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(column).alias("v"))
    return named.mapInArrow(pack, "id long, dims int, vec binary")


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the symmetric matrix ``near`` connects, each of them in ``near``."""
    left = near.any(axis=1)
    tops, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    while left.any():
        front = np.array([left.argmax()])
        left[front] = False
        while len(front):
            hit = near[front] & left
            new = np.flatnonzero(hit.any(axis=0))
            tops.append(front[hit[:, new].argmax(axis=0)])
            ends.append(new)
            left[new] = False
            front = new
    return np.concatenate(tops), np.concatenate(ends)


def nearest(ids: np.ndarray, x: np.ndarray, k: int, threshold: float, fresh: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each row's nearest k others: a, b, sim, link.  ``fresh``: only pairs with such a row count.

    Rows with ``link`` are a spanning forest of all pairs at or above the threshold.
    """
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    near = sim >= threshold
    top, end = forest(near | near.T)
    linked = np.maximum(sim[top, end], sim[end, top])
    if fresh is not None:
        fresh = fresh[order]
        sim[~(fresh[:, None] | fresh[None, :])] = -2
    k = min(k, len(ids) - 1)
    if k < 1:
        return ids[:0], ids[:0], np.zeros(0), np.zeros(0, bool)
    at = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    a, b, s = np.repeat(ids, k), ids[at.ravel()], np.take_along_axis(sim, at, 1).ravel()
    keep = (s > -2) & (a != b)
    a, b, s = (np.concatenate(p) for p in ((a[keep], ids[top]), (b[keep], ids[end]), (s[keep], linked)))
    return a, b, np.clip(s, -1.0, 1.0), np.arange(len(a)) >= keep.sum()


def edge_table(parts: list[tuple]) -> pa.Table:
    a, b, s = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
    return pa.table({"a": a.astype(np.int64), "b": b.astype(np.int64), "sim": s.astype(np.float64)})


def list_table(parts: list[tuple]) -> pa.Table:
    link = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, bool)
    return edge_table([p[:3] for p in parts]).append_column("link", pa.array(link))


def code_bits(n: int) -> int:
    return max(0, round(math.log2(max(1, n / GROUP))))


def tables_for(n: int, threshold: float) -> int:
    """Tables after which a pair at ``threshold`` has shared no code with a chance of MISSED at most."""
    same = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** code_bits(n)
    return max(TABLES, math.ceil(math.log(MISSED) / math.log1p(-same))) if same < 1 else TABLES


def first_graph(nodes: DataFrame, n: int, seed: int, k: int, tables: int, threshold: float) -> DataFrame:
    """Edges to the nearest k inside groups of equal sign codes."""
    bits = code_bits(n)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            ids, raw = batch.column("id").to_numpy(), batch.column("vec").to_pylist()
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                x = unit([raw[i] for i in own])
                for t in range(tables):
                    planes = np.random.default_rng([seed, t, int(d)]).standard_normal((int(d), bits))
                    codes = ((x @ planes > 0) << np.arange(bits)).sum(axis=1) if bits else np.zeros(len(own), np.int64)
                    group = (codes.astype(np.int64) * tables + t) * 100_003 + int(d)
                    yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(ids[own])], names=["grp", "id"])

    coded = stored(nodes.select("id", "dims", "vec").mapInArrow(code, "grp long, id long"), "codes")
    sizes = coded.groupBy("grp").agg(F.ceil(F.count("*") / CROWDED).alias("splits"))
    dealt = coded.join(sizes, "grp").withColumn("split", F.pmod(F.xxhash64("id", "grp", F.lit(seed)), F.col("splits")))

    def group(got: pa.Table) -> pa.Table:
        return list_table([nearest(got["id"].to_numpy(), unit(got["vec"].to_pylist()), k, threshold)])

    return dealt.join(nodes.select("id", "vec"), "id").select("grp", "split", "id", "vec").groupBy("grp", "split").applyInArrow(group, LISTS)


def best(edges: DataFrame, k: int) -> DataFrame:
    """The k best of each list (``listed``) and every ``link``; ``age`` is an edge's least round."""
    once = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.max("link").alias("link"), F.min("age").alias("age"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("listed", place <= k).where("listed or link")


def descend(graph: DataFrame, nodes: DataFrame, k: int, age: int, threshold: float) -> DataFrame:
    """Candidate edges between the listed neighbours of each node."""
    graph = graph.where("listed")
    both = graph.select(F.col("a").alias("v"), F.col("b").alias("id"), "age").unionByName(graph.select(F.col("b").alias("v"), F.col("a").alias("id"), "age"))
    both = both.groupBy("v", "id").agg((F.max("age") == age - 1).alias("fresh"))
    degree = both.groupBy("v").agg(F.ceil(F.count("*") / PART).alias("parts"), F.max("fresh").alias("some")).where("some")
    dealt = both.join(degree, "v").withColumn("part", F.pmod(F.xxhash64("id", F.lit(age)), F.col("parts")))
    ready = dealt.join(nodes.select("id", "dims", "vec"), "id").select("v", "part", "id", "fresh", "dims", "vec")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(got: pa.Table) -> Iterator[pa.RecordBatch]:
            v, part = got["v"].to_numpy(), got["part"].to_numpy()
            ids, fresh, raw = got["id"].to_numpy(), got["fresh"].to_numpy(zero_copy_only=False), got["vec"].to_pylist()
            cuts = [0, *(np.flatnonzero((np.diff(v) != 0) | (np.diff(part) != 0)) + 1).tolist(), len(v)]
            parts = [nearest(ids[s:e], unit(raw[s:e]), k, threshold, fresh[s:e]) for s, e in zip(cuts, cuts[1:], strict=False) if e - s > 1]
            yield from list_table(parts).to_batches()

        held: pa.Table | None = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            held = got if held is None else pa.concat_tables([held, got]).combine_chunks()
            v, part = held["v"].to_numpy(), held["part"].to_numpy()
            last = np.flatnonzero((v != v[-1]) | (part != part[-1])) if len(v) else []
            if len(last):
                yield from emit(held.slice(0, last[-1] + 1))
                held = held.slice(last[-1] + 1)
        if held is not None and held.num_rows:
            yield from emit(held)

    return ready.repartition("v", "part").sortWithinPartitions("v", "part").mapInArrow(compare, LISTS).withColumn("age", F.lit(age))


def counted(groups: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """(id, links): for every node of a component, linked rows, counted by blocks of the component.

    ``groups`` is (id, component_id).  Pairs of blocks are compared in tasks; only sums leave them.
    """
    sizes = groups.groupBy("component_id").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = groups.join(sizes, "component_id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    packed = stored(
        dealt.join(nodes.select("id", "vec", "copies"), "id").groupBy("component_id", "blocks", "block")
        .agg(F.collect_list(F.struct("id", "copies", "vec")).alias("rows")),
        "blocks",
    )
    left = packed.select("component_id", "block", "rows", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("other"))
    right = packed.select("component_id", F.col("block").alias("other"), F.col("rows").alias("others"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                mine, theirs = batch.column("rows")[i].as_py(), batch.column("others")[i].as_py()
                ids, others = (np.array([r["id"] for r in rows], np.int64) for rows in (mine, theirs))
                copies = np.array([r["copies"] for r in theirs], np.int64)
                near = unit([r["vec"] for r in mine]) @ unit([r["vec"] for r in theirs]).T >= threshold
                near &= ids[:, None] != others[None, :]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(near @ copies)], names=["id", "links"])

    pairs = left.join(right, ["component_id", "other"]).select("rows", "others")
    return pairs.mapInArrow(compare, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def drawn(nodes: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors, by length, of at most ``sample`` nodes in hash order."""
    # At most ``sample`` vectors come to the driver.
    rows = nodes.select("id", "dims", "vec").orderBy(F.xxhash64("id")).limit(sample).collect()
    known = {}
    for d in {r["dims"] for r in rows}:
        own = [r for r in rows if r["dims"] == d]
        known[d] = np.array([r["id"] for r in own], np.int64), unit([bytes(r["vec"]) for r in own])
    return known


def audit(nodes: DataFrame, groups: DataFrame, known: dict, threshold: float) -> DataFrame:
    """a, component, b, links: for each drawn node, its links into each component, and one of them.

    ``groups`` is (id, component_id); a node without a row there is its own component.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, ids, raw = batch.column("dims").to_numpy(), batch.column("id").to_numpy(), batch.column("vec").to_pylist()
            component = batch.column("component").to_numpy()
            for d, (asked, q) in known.items():
                own = np.flatnonzero(dims == d)
                x = unit([raw[i] for i in own]) if len(own) else q[:0]
                for s in range(0, len(asked), BLOCK):
                    i, j = np.nonzero((q[s : s + BLOCK] @ x.T >= threshold) & (asked[s : s + BLOCK, None] != ids[own][None, :]))
                    if len(i):
                        places, place = np.unique(component[own], return_inverse=True)
                        pairs, first, links = np.unique(i * len(places) + place[j], return_index=True, return_counts=True)
                        columns = asked[s + pairs // len(places)], places[pairs % len(places)], ids[own[j[first]]], links
                        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["a", "component", "b", "links"])

    placed = nodes.select("id", "dims", "vec").join(groups, "id", "left").select("id", "dims", "vec", F.coalesce("component_id", "id").alias("component"))
    parts = placed.mapInArrow(compare, "a long, component long, b long, links long")
    return parts.groupBy("a", "component").agg(F.min("b").alias("b"), F.sum("links").alias("links"))


def recalls(links: DataFrame, groups: DataFrame, k: int) -> tuple[dict[bool, float], int]:
    """Mean share of links inside the own component, for nodes of at most k links (False) and of more (True); how many have few."""
    own = links.join(groups.select(F.col("id").alias("a"), F.col("component_id").alias("mine")), "a", "left")
    inside = F.when(F.col("component") == F.coalesce("mine", "a"), F.col("links")).otherwise(0)
    each = own.groupBy("a").agg(F.sum(inside).alias("found"), F.sum("links").alias("wanted"))
    # Two rows.
    got = {r["many"]: r for r in each.groupBy((F.col("wanted") > k).alias("many")).agg(F.avg(F.col("found") / F.col("wanted")).alias("recall"), F.count("*").alias("n")).collect()}
    return {many: r["recall"] for many, r in got.items()}, got[False]["n"] if False in got else 0


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", threshold: float = 0.95, k: int = K, rounds: int = 3, recall: float = 0.99) -> DataFrame:
    """vec_id, n_links, component_id, kept for each vector.

    Attempts end when the audit's ``recall`` is met; ``rounds`` in a row without gain are an error.
    """
    every = stored(prepared(vectors, id_column, column), "vectors")
    shared = every.where("vec is not null").groupBy("vec", "dims").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
    # A node is a vector, whatever ids it has; stored, so that its number stays.
    nodes = stored(shared.select(F.monotonically_increasing_id().alias("id"), "least", "dims", "vec", "copies"), "nodes")
    n = nodes.count()
    tables = tables_for(n, threshold)
    pool = first_graph(nodes, n, 0, k, tables, threshold).withColumn("age", F.lit(0))
    graph = stored(best(pool, k), "graph")
    age, attempt, size, top, idle = 0, 0, 0, -1.0, 0
    known = drawn(nodes, AUDITS[size])
    while True:
        while True:
            age += 1
            graph = stored(best(graph.drop("listed").unionByName(descend(graph, nodes, k, age, threshold)), k), "graph")
            if graph.where(F.col("listed") & (F.col("age") == age)).count() <= 0.001 * n * k:
                break
        near = graph.where(F.col("sim") >= threshold).select("a", "b")
        groups = stored(components(near, 1 + n // 20_000), "groups", 1 + n // 100_000)
        while True:
            links = stored(audit(nodes, groups, known, threshold), "audit", 1 + n // 100_000)
            got, few = recalls(links, groups, k)
            if few >= ENOUGH or size + 1 == len(AUDITS) or n <= AUDITS[size]:
                break
            size, top, idle = size + 1, -1.0, 0
            known = drawn(nodes, AUDITS[size])
        attempt += 1
        least = min(got.values(), default=None)
        if n <= AUDITS[size] or (attempt >= rounds if least is None else least >= recall):
            break
        if least is not None:
            top, idle = max(top, least), 0 if least > top else idle + 1
            if idle >= rounds:
                raise RuntimeError(f"the graph of {n} vectors holds {least:.4f} of the links of audited nodes (few, many links: {got}) after {attempt} attempts; {recall} are wanted")
        age += 1
        more = first_graph(nodes, n, attempt, k, tables, threshold).withColumn("age", F.lit(age))
        graph = stored(best(graph.drop("listed").unionByName(more), k), "graph")
    if min(got.values(), default=1.0) < 1:
        groups = stored(components(near.unionByName(links.select("a", "b")), 1 + n // 20_000), "groups", 1 + n // 100_000)
    links = counted(groups, nodes, threshold)
    first = nodes.join(groups, "id").groupBy("component_id").agg(F.min("least").alias("first"))
    judged = nodes.join(groups, "id", "left").join(first, "component_id", "left").join(links, "id", "left").select(
        "vec", "dims", F.coalesce("first", "least").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    with_vec = every.where("vec is not null").join(judged, ["vec", "dims"]).select("id", "links", "component")
    rest = every.where("vec is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("component"))
    return with_vec.unionByName(rest).select(
        F.col("id").alias("vec_id"), F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def op10_neighbours(spark, sf_dir: str) -> DataFrame:
    """Near copies among all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS row, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
p AS (
  SELECT a.row AS a, b.row AS b FROM good a JOIN good b ON a.row <> b.row AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r(a, b) AS (SELECT row, row FROM v WHERE vec_id IS NOT NULL UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT r.a, min(v.vec_id) AS component_id FROM r JOIN v ON r.b = v.row GROUP BY r.a),
n AS (SELECT a, count(*) AS n FROM p GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, coalesce(v.vec_id = c.component_id, false) AS kept
FROM v LEFT JOIN c ON v.row = c.a LEFT JOIN n ON v.row = n.a
"""
