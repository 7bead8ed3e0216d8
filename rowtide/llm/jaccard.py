"""Similarity join of documents on word n-grams: Jaccard of 0.8 or more, exactly.

1. *Order.*  Documents are dealt into batches by the hash of their id.  Each batch reduces its
   documents to different sets (copies inside a batch meet here) and sends every n-gram it
   holds once, with the number of its sets, to that n-gram's bucket.  A bucket adds up and
   answers each batch with the n-grams that more than one set holds.  An n-gram of every
   document costs a bucket one entry per batch, not one per document.
2. *Prefixes.*  In every set, n-grams stand from rare to frequent (ties: by hash).  Two sets
   that are similar enough share an n-gram among their first n - ceil(0.8 n) + 1.  N-grams of
   one set cannot match, so only the frequent rest of a prefix is kept; most sets keep none.
3. *Candidates.*  Sets equal in all batches become one node.  Nodes meet at shared prefix
   n-grams, under a length and a positional filter, first only with the least node of each
   n-gram; every candidate pair is verified once: a suffix filter compares what stands behind
   the shared n-gram, then the sets are intersected.  Then all pairs at n-grams
   whose nodes are not yet in one component, under a bitmap filter too, are verified likewise, so no
   connection is missed, and a large group of near copies does not emit all its pairs.

The result has one row per input row.  Null text and text without words have no n-grams,
n_shingles 0 and themselves as component.  With fewer than n words the whole sequence is one
n-gram.  Rows with one id are one node of the graph.  A null id has a null component and
links with nothing.  Extra columns are ignored; an empty table gives an empty result.

N-grams are compared by 64-bit hashes and sets by 128-bit digests.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import Index, Scratch, give_back, mix, small, stored, table, unused
from rowtide.llm.components import components

#: n-grams of a batch and of a bucket, as far as the corpus is small.
BATCH_GRAMS = 1_000_000
SENT = "bucket int, batch int, grams binary, repeated binary, counts binary"
KNOWN = "batch int, bucket int, grams binary, counts binary"
SETS = "doc_id long, n_shingles long, node long, digest binary, grams array<long>, places array<int>, parity array<long>, members binary"
WORD_LIMIT = 150_000
#: Ranges of hashes that the bitmap filter counts, and the suffix filter.
PARTS = 1024
SUFFIX_RANGES = 64
SUFFIX_SHIFT = np.uint64(64 - 6)
#: Ids that are broadcast, at 16 bytes each, and rows of ids to a file.
BROADCAST_ROWS = 1_000_000
FILE_ROWS = 200_000


def packed(values: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane: planes of small numbers compress to nothing."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def steps(ascending: np.ndarray) -> bytes:
    """Ascending 32-bit numbers by their differences."""
    return packed(np.diff(ascending, prepend=ascending.dtype.type(0)))


def climbed(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint32)


class Shingler:
    """Sets of hashed word n-grams; remembers the hashes of words."""

    def __init__(self, n: int):
        self.n, self.index, self.hashes = n, Index(), np.zeros(0, np.uint64)

    def _hash(self, words: list[bytes]) -> np.ndarray:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
        starts = np.cumsum(lengths) - lengths
        powers = np.cumprod(np.full(int(lengths.max()), 0x100000001B3, np.uint64))
        inside = np.arange(len(data)) - np.repeat(starts, lengths)
        return mix(np.add.reduceat(data * powers[inside], starts) + lengths.astype(np.uint64))

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """The sorted distinct n-gram hashes of each text (UTF-8)."""
        if len(self.index) > WORD_LIMIT:
            self.index, self.hashes = Index(), np.zeros(0, np.uint64)
        words, counts = [], []
        for text in texts:
            own = (text or b"").lower().split()
            words += own
            counts.append(len(own))
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.fresh:
            self.hashes = np.concatenate([self.hashes, self._hash(self.index.fresh)])
            self.index.fresh = []
        out, start, n = [], 0, self.n
        odd = np.uint64(0x9E3779B97F4A7C15)
        for count in counts:
            h = self.hashes[at[start : start + count]]
            start += count
            width = min(n, count)
            if not width:
                out.append(np.zeros(0, np.uint64))
                continue
            s = np.full(count - width + 1, width, np.uint64)
            for j in range(width):
                s = s * odd + h[j : count - width + 1 + j]
            out.append(np.unique(mix(s)))
        return out


def distinct_sets(shingler: Shingler, got: pa.Table) -> tuple[list, list[np.ndarray], list[int], np.ndarray]:
    """ids of rows, different sets (empty ones and those of null ids left out), set of each row or -1, sizes."""
    ids = got["doc_id"].to_pylist()
    texts = got["text"].cast(pa.binary()).to_pylist()
    seen: dict[bytes, int] = {}
    sets, owner, sizes = [], [], np.zeros(len(ids), np.int64)
    for start in range(0, len(ids), 500):
        for i, own in enumerate(shingler.sets(texts[start : start + 500]), start):
            sizes[i] = len(own)
            if not len(own) or ids[i] is None:
                owner.append(-1)
                continue
            key = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            at = seen.setdefault(key, len(seen))
            if at == len(sets):
                sets.append(own)
            owner.append(at)
    return ids, sets, owner, sizes


def parity_of(own: np.ndarray) -> np.ndarray:
    """One bit for each of PARTS ranges of the hashes: whether an odd number of members lies there."""
    counts = np.bincount((own >> np.uint64(64 - PARTS.bit_length() + 1)).astype(np.int64), minlength=PARTS)
    return np.packbits(counts & 1).view(np.int64)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many n-grams of a set may hold the first shared one."""
    return n - (4 * n + 4) // 5 + 1


def _send(n: int, buckets: int):
    def send(got: pa.Table) -> pa.Table:
        give_back()
        batch = got["batch"][0].as_py()
        _, sets, _, _ = distinct_sets(Shingler(n), got)
        grams, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_counts=True)
        bucket = (grams >> np.uint64(32)) % np.uint64(buckets)
        low = grams.astype(np.uint32)
        order = np.lexsort((low, bucket))
        grams, counts, bucket = low[order], counts[order].astype(np.uint32), bucket[order].astype(np.int32)
        cuts = np.flatnonzero(np.diff(bucket)) + 1 if len(bucket) else []
        rows = []
        for at, g, c in zip(np.split(bucket, cuts), np.split(grams, cuts), np.split(counts, cuts), strict=True):
            if len(g):
                many = np.flatnonzero(c > 1).astype(np.uint32)
                rows.append({"bucket": int(at[0]), "batch": batch, "grams": steps(g), "repeated": packed(many), "counts": packed(c[many])})
        return pa.Table.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("grams", pa.binary()), ("repeated", pa.binary()), ("counts", pa.binary())]))

    return send


def _add_up(got: pa.Table) -> pa.Table:
    """Totals of a bucket; each batch gets those of its n-grams that occur more than once."""
    grams = [climbed(g) for g in got["grams"].to_pylist()]
    sizes = np.array(list(map(len, grams)))
    every = np.concatenate(grams)
    counts = np.ones(len(every), np.int64)
    starts = np.cumsum(sizes) - sizes
    for start, many, c in zip(starts, got["repeated"].to_pylist(), got["counts"].to_pylist(), strict=True):
        counts[start + unpacked(many)] = unpacked(c)
    known, inverse = np.unique(every, return_inverse=True)
    totals = np.bincount(inverse, weights=counts, minlength=len(known)).astype(np.int64)[inverse]
    bucket, rows = got["bucket"][0].as_py(), []
    for start, size, batch in zip(starts, sizes, got["batch"].to_pylist(), strict=True):
        part = slice(start, start + size)
        keep = totals[part] > 1
        if keep.any():
            most = np.minimum(totals[part][keep], (1 << 32) - 1).astype(np.uint32)
            rows.append({"batch": batch, "bucket": bucket, "grams": steps(every[part][keep]), "counts": packed(most)})
    return pa.Table.from_pylist(rows, schema=pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("grams", pa.binary()), ("counts", pa.binary())]))


def _prefixes(n: int, buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("digest", pa.binary()), ("grams", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())), ("parity", pa.list_(pa.int64())), ("members", pa.binary())])

    def prefixes(got: pa.Table, answer: pa.Table) -> pa.Table:
        give_back()
        if not got.num_rows:
            return pa.Table.from_pylist([], schema=schema)
        ids, sets, owner, sizes = distinct_sets(Shingler(n), got)
        parts = zip(answer["bucket"].to_pylist(), answer["grams"].to_pylist(), strict=True)
        keys = np.concatenate([np.zeros(0, np.uint64), *(np.uint64(b) << np.uint64(32) | climbed(g).astype(np.uint64) for b, g in parts)])
        counts = np.concatenate([np.zeros(0, np.uint32), *(unpacked(c) for c in answer["counts"].to_pylist())])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        nodes = [None] * len(sets)
        for i, at in enumerate(owner):
            if at >= 0 and (nodes[at] is None or ids[i] < nodes[at]):
                nodes[at] = ids[i]
        kept: list[tuple | None] = []
        for own in sets:
            key = ((own >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (own & np.uint64(0xFFFFFFFF))
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            shared = keys[at] == key if len(keys) else np.zeros(len(own), bool)
            alone, length = int((~shared).sum()), int(prefix_length(np.int64(len(own))))
            if alone >= length:
                kept.append(None)
                continue
            grams = own[shared]
            ordered = grams[np.lexsort((grams, counts[at[shared]]))]
            ranked = ordered[: length - alone]
            digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
            kept.append((digest, ranked.view(np.int64), np.arange(alone, alone + len(ranked), dtype=np.int32), parity_of(own), np.concatenate([own[~shared], ordered]).tobytes()))
        out, told = [], set()
        for i, at in enumerate(owner):
            row = {"doc_id": ids[i], "n_shingles": int(sizes[i]), "node": ids[i] if at < 0 else nodes[at]}
            if at >= 0 and at not in told and nodes[at] == ids[i]:
                told.add(at)
                if kept[at]:
                    row |= dict(zip(("digest", "grams", "places", "parity", "members"), kept[at], strict=True))
            out.append(row)
        return pa.Table.from_pylist(out, schema=schema)

    return prefixes


def document_sets(docs: DataFrame, n: int) -> DataFrame:
    """One row per document; those that may link also have digest, prefix n-grams, their places and the set."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    grams = max(BATCH_GRAMS, math.isqrt(64 * (total // 6)))
    batches = max(1, math.ceil(total / 6 / grams))
    spread = F.pmod(F.xxhash64(F.coalesce("doc_id", F.xxhash64("text"))), F.lit(batches)).cast("int")
    # A few batches to a task: they come one after the other, and fewer files are written.
    dealt = docs.withColumn("batch", spread).repartition(math.ceil(batches / 3), "batch")
    sent = dealt.groupBy("batch").applyInArrow(_send(n, batches), SENT)
    known = sent.groupBy("bucket").applyInArrow(_add_up, KNOWN)
    return dealt.groupBy("batch").cogroup(known.groupBy("batch")).applyInArrow(_prefixes(n, batches), SETS)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common members of two sets."""
    return len(np.intersect1d(a, b, assume_unique=True))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets reach a Jaccard of 0.8."""
    return 9 * overlap(a, b) >= 4 * (len(a) + len(b))


def suffix_fits(a: np.ndarray, b: np.ndarray, i: int, j: int) -> bool:
    """The suffix filter: what stands behind a shared member, at ``i`` and ``j`` of two sets in rank order.

    Members before it can only meet members before it.  Those behind are dealt into ranges of
    hashes; where one set has more than the other, they differ by as many.
    """
    count = lambda x: np.bincount((x >> SUFFIX_SHIFT).astype(np.int64), minlength=SUFFIX_RANGES)
    x, y = a[i + 1 :], b[j + 1 :]
    apart = int(np.abs(count(x) - count(y)).sum())
    most = min(i, j) + 1 + (len(x) + len(y) - apart) // 2
    return 9 * most >= 4 * (len(a) + len(b))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b; i, j: the places of a shared n-gram) whose sets are similar."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("x", "y")]
            places = [batch.column(c).to_pylist() for c in ("i", "j")]
            keep = pa.array([suffix_fits(x, y, i, j) and similar(x, y) for x, y, i, j in zip(*own, *places, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(keep)

    few = pairs.count() <= BROADCAST_ROWS
    near = F.broadcast if few else (lambda df: df)
    x = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("members").alias("y")).join(near(pairs.select("b").distinct()), "b", "left_semi")
    return x.join(near(pairs), "a").join(y, "b").select("a", "b", "i", "j", "x", "y").mapInArrow(verify, "a long, b long")


def once(met: DataFrame, a: str, b: str) -> DataFrame:
    """Each pair of nodes once, with the first places where they meet."""
    at = F.min(F.struct(F.col(f"{a}.place").alias("i"), F.col(f"{b}.place").alias("j"))).alias("at")
    return met.groupBy(F.col(f"{a}.node").alias("a"), F.col(f"{b}.node").alias("b")).agg(at).select("a", "b", "at.i", "at.j")


def fits(a: str, b: str):
    """Length and positional filters for postings ``a`` and ``b`` of one n-gram."""
    na, nb, pa_, pb = F.col(f"{a}.n"), F.col(f"{b}.n"), F.col(f"{a}.place"), F.col(f"{b}.place")
    length = (5 * na >= 4 * nb) & (5 * nb >= 4 * na)
    most = F.least(pa_, pb) + 1 + F.least(na - pa_ - 1, nb - pb - 1)
    return length & (9 * most >= 4 * (na + nb))


def close(a: str, b: str):
    """A bitmap filter over the whole sets, before any set is moved: where the parity of a range differs, the sets differ by a member at least."""
    x, y = F.col(f"{a}.parity"), F.col(f"{b}.parity")
    apart = sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(1, PARTS // 64)), F.bit_count(F.get(x, F.lit(0)).bitwiseXOR(F.get(y, F.lit(0)))))
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    return 9 * apart <= both


def links(sets: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, component_id) of the nodes of ``sets`` that are linked with another."""
    # Answered from the files' footers; the number of tasks for what follows grows with it.
    n = sets.count()
    tasks = 1 + n // 20_000
    first = scratch(sets.where("digest is not null").groupBy("digest").agg(F.min("node").alias("node")), "first", tasks)
    few = first.count() <= BROADCAST_ROWS
    nodes = sets.where("digest is not null").join(F.broadcast(first) if few else first, ["digest", "node"], "left_semi")
    postings = scratch(
        nodes.select("node", F.col("n_shingles").alias("n"), F.explode(F.arrays_zip("grams", "places")).alias("at"))
        .select(F.col("at.grams").alias("gram"), F.struct("node", "n", F.col("at.places").alias("place")).alias("p")),
        "postings",
        tasks,
    )
    # Copies in other batches, and rows that share an id, are connected by what they are.
    members = sets.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    copies = sets.where("digest is not null").select("digest", F.col("node").alias("a")).join(first.withColumnRenamed("node", "b"), "digest").where("a <> b").select("a", "b")
    hubs = postings.groupBy("gram").agg(F.min("p").alias("q"))
    met = postings.join(hubs, "gram").where((F.col("p.node") != F.col("q.node")) & fits("p", "q"))
    stars = scratch(once(met, "q", "p"), "pairs", tasks)
    edges = members.unionByName(copies).unionByName(scratch(verified(stars, nodes), "links", tasks))
    merged = components(edges, tasks, scratch)
    # N-grams whose nodes are all connected have nothing more to tell.
    named = postings.join(merged, F.col("p.node") == merged["id"], "left").select("gram", "p", F.coalesce("component_id", "p.node").alias("c"))
    mixed = named.groupBy("gram").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("gram")
    rest = named.join(mixed, "gram").join(nodes.select(F.col("node").alias("owner"), "parity"), F.col("p.node") == F.col("owner"))
    open_ = scratch(rest.select("gram", F.col("p").withField("parity", F.col("parity")).alias("p"), "c"), "open", tasks)
    other = open_.select("gram", F.col("p").alias("q"), F.col("c").alias("d"))
    met = open_.join(other, "gram").where((F.col("c") != F.col("d")) & (F.col("p.node") < F.col("q.node")) & fits("p", "q") & close("p", "q"))
    pairs = once(met, "p", "q").join(stars, ["a", "b"], "left_anti")
    found = scratch(verified(scratch(pairs, "pairs", tasks), nodes), "links", tasks)
    if found.isEmpty():
        return merged
    return components(edges.unionByName(found), tasks, scratch)


def join_documents(docs: DataFrame, n: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    scratch = Scratch()
    sets = scratch(document_sets(docs, n), "sets")
    # Answered from the files' footers.
    rows = sets.count()
    found = links(sets, scratch)
    joined = stored(
        sets.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("id"), "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
        ),
        "joined",
        1 + rows // FILE_ROWS,
    )
    scratch.clear()
    return joined


def first_copies(docs: DataFrame, n: int = 5) -> DataFrame:
    """``docs`` without those rows that are near copies of a row with a smaller id.

    Rows are told apart by id and text.  Of rows that share an id, each different text is judged
    for itself, and of equal rows one stays; among near copies with one id, one text stays.  Texts without
    words and rows with a null id stay.  Extra columns stay, whatever their names.
    """
    node, a, b = (unused(docs, name) for name in ("node", "text_hash", "text_check"))
    own = docs.withColumns({a: F.xxhash64("text"), b: F.xxhash64(F.lit(1), "text")})
    keyed = own.select(F.col("doc_id").cast("long").alias("id"), F.col(a).alias("a"), F.col(b).alias("b")).where("id is not null")
    twice = stored(keyed.groupBy("id").agg(F.count("*").alias("rows"), F.min(F.struct("a", "b")).alias("first")).where("rows > 1"), "repeated-ids")
    if twice.isEmpty():
        numbered, extra, again = docs.withColumn(node, F.col("doc_id").cast("long")), None, None
    else:
        low = min(0, keyed.agg(F.min("id")).first()[0]) - 1
        each = keyed.join(small(twice), "id").groupBy("id", "a", "b", "first").agg(F.count("*").alias("copies"))
        fresh = F.when(F.struct("a", "b") != F.col("first"), F.lit(low) - F.monotonically_increasing_id())
        # Stored, so that a repeated task finds the same numbers.
        texts = stored(each.select("id", "a", "b", "copies", F.coalesce(fresh, "id").alias("number")), "repeated-texts")
        extra = texts.where("number <> id")
        again = stored(texts.where("copies > 1").select(F.col("number").alias(node)), "repeated-rows")
        left = small(stored(extra.select(F.col("id").alias("id_"), F.col("a").alias("a_"), F.col("b").alias("b_"), "number"), "fresh-ids"))
        met = own.join(left, (own["doc_id"].cast("long") == left["id_"]) & (own[a] == left["a_"]) & (own[b] == left["b_"]), "left")
        numbered = met.select(*[own[c] for c in docs.columns], F.coalesce(left["number"], own["doc_id"].cast("long")).alias(node))
    found = join_documents(numbered.select(F.col(node).alias("doc_id"), "text"), n)
    if extra is not None:
        real = found.join(extra.select(F.col("number").alias("doc_id"), "id"), "doc_id", "left").withColumn("id", F.coalesce("id", "doc_id"))
        best = real.where("component_id is not null").groupBy("component_id").agg(F.min_by("doc_id", F.struct("id", "doc_id")).alias("stays"))
        found = found.join(best, "component_id").select("doc_id", F.col("stays").alias("component_id"))
    gone = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias(node)).distinct(), "gone", 1 + found.count() // FILE_ROWS)
    kept = numbered.join(small(gone), node, "left_anti")
    if again is not None:
        few = small(again)
        kept = kept.join(few, node, "left_anti").unionByName(kept.join(few, node, "left_semi").dropDuplicates([node]))
    return kept.drop(node)


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    """Near copies among all documents."""
    return join_documents(table(spark, sf_dir, "documents"))
