"""Ranked lexical search over K2-treaps of the term-document grid.

1. One pass counts the documents that have terms, and their terms.
2. *Index.*  Each task cuts its documents into shards of bounded size, without a shuffle.  A
   shard is a grid: a row for each of its terms, frequent ones first, a column for each document;
   a cell holds the impact of the term in the document.  It is kept as a K2-treap (``treap.py``)
   beside its dictionary, both compressed by the worker; every term of every document is in it.
3. Document frequencies of the wanted terms come from the dictionaries.
4. *Search.*  In every shard the row paths of an item's terms descend together, best first over
   ranges of documents; ranges whose bound is below the item's k-th score so far are left out.
   A task keeps one list of k for each item over all its shards, and the lists are merged.

Items are a stated query set, met with all shards in blocks; blocks are broadcast while their
terms are few by count, and joined by a shuffle beyond that.

Null text has no terms.  A row of documents is a document, also where ids or whole rows repeat;
a null id is counted, and comes after all others among equal scores.  Rows of items that repeat an
id are items of their own, ranked apart; an item with no term, or without any hit, has no rows.  Extra
columns are ignored; empty tables give an empty result.  A text of any length is read in slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.collocations import slices
from rowtide.llm.common import CHUNK_CHARS, Index, forget, give_back, in_batches, slices_of, stored, table
from rowtide.llm.decontaminate import words
from rowtide.llm.jaccard import packed, unpacked
from rowtide.llm.treap import Treap, build, expanded, squeezed

#: Terms of a shard, with repeats, and its documents, at most (but for one document).
SHARD_TOKENS = 1_500_000
SHARD_DOCUMENTS = 1 << 16
#: Bytes of compressed shards that a task of the JVM holds at once (but for one shard).
GROUP_BYTES = 8 << 20
#: Terms that wait until equal ones are put together.
PENDING = 500_000
#: Terms of a block of items; terms that are broadcast.
BLOCK_TERMS = 50_000
BROADCAST_TERMS = 500_000
#: The id of documents without one, behind all others.
NO_ID = np.iinfo(np.int64).max

# Fixed value: what parts terms, all ASCII but digits and letters; A-Z are lower-cased.
TERMS = bytes.maketrans(
    bytes(range(128)),
    bytes(c if chr(c).isalnum() else 32 for c in range(128)).lower(),
)
SHARD = "ids binary, known binary, terms binary, df binary, height int, root long, bits array<binary>, drops array<binary>"


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    for part in slices(text or b""):
        yield part.translate(TERMS).split()


def sizes(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = total = 0
        for batch in slices_of(batches, CHUNK_CHARS):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                n = sum(map(len, terms_of(text)))
                documents, total = documents + (n > 0), total + n
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([total])], names=["n", "l"])

    got = in_batches(docs.select("text"), count, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return got[0] or 0, got[1] or 0


class Shard:
    """Documents on their way into one grid."""

    def __init__(self) -> None:
        self.index = Index()
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.parts: list[np.ndarray] = []
        self.waiting = self.total = 0
        self.cells = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        n = 0
        for own in terms_of(text):
            at = np.fromiter(map(self.index.__getitem__, own), np.int64, len(own))
            self.parts.append(at + (len(self.ids) << 32))
            n += len(own)
            self.waiting += len(own)
            if self.waiting >= PENDING:
                self.settle()
        self.ids.append(doc_id)
        self.lengths.append(n)
        self.total += n

    def settle(self) -> None:
        """Put equal cells together."""
        cell, tf = np.unique(np.concatenate([np.zeros(0, np.int64), *self.parts]), return_counts=True)
        every, inverse = np.unique(np.concatenate([self.cells[0], cell]), return_inverse=True)
        self.cells = [every, np.bincount(inverse, weights=np.concatenate([self.cells[1], tf]), minlength=len(every)).astype(np.int64)]
        self.parts, self.waiting = [], 0

    def row(self, documents: int, total: int) -> dict | None:
        self.settle()
        cell, tf = self.cells
        if not len(cell):
            return None
        doc, term = cell >> 32, cell & 0xFFFFFFFF
        df = np.bincount(term, minlength=len(self.index))
        order = np.argsort(-df, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # Python's numbers: the product may pass 64 bits.
        m = np.array([10 + 90 * n * documents // total for n in self.lengths], np.int64)
        impact = (10**9 * tf) // (1000 * tf + 8 * m[doc])
        names = list(self.index)
        kept = {
            "ids": squeezed(np.array([0 if i is None else i for i in self.ids], np.int64).tobytes()),
            "known": squeezed(np.array([i is not None for i in self.ids], np.uint8).tobytes()),
            "terms": squeezed(b" ".join([names[i] for i in order.tolist()])),
            "df": squeezed(packed(df[order])),
        }
        return kept | build(place[term], doc, impact)


def index(docs: DataFrame, documents: int, total: int) -> DataFrame:
    """Shards of ``docs`` (doc_id, text), written to the shared folder."""
    schema = pa.schema([
        ("ids", pa.binary()), ("known", pa.binary()), ("terms", pa.binary()), ("df", pa.binary()), ("height", pa.int32()), ("root", pa.int64()),
        ("bits", pa.list_(pa.binary())), ("drops", pa.list_(pa.binary())),
    ])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard()

        def done() -> Iterator[pa.RecordBatch]:
            if row := shard.row(documents, total):
                yield pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in slices_of(batches, CHUNK_CHARS):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                shard.add(doc_id, text)
                if shard.total >= SHARD_TOKENS or len(shard.ids) >= SHARD_DOCUMENTS:
                    yield from done()
                    shard = Shard()
                    give_back()
        yield from done()

    made = in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shards, SHARD)
    # Compressed by the workers: the JVM never holds a whole grid.
    return stored(made, "treaps", compression="none", group=GROUP_BYTES)


def in_blocks(shards: DataFrame, asked: DataFrame, terms: int) -> DataFrame:
    """Every shard beside every block of ``asked`` (block, asked); ``terms`` of them in all."""
    few = terms <= BROADCAST_TERMS
    number = blocks_for(terms)
    every = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(number - 1))))
    return every.join(F.broadcast(asked) if few else asked, "block").drop("block")


def blocks_for(terms: int) -> int:
    return max(1, -(-terms // BLOCK_TERMS))


def frequencies(shards: DataFrame, wanted: DataFrame) -> DataFrame:
    """term, df of the terms ``wanted`` that any document has."""
    n = wanted.count()
    dealt = wanted.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(blocks_for(n))).cast("int"))
    asked = dealt.groupBy("block").agg(F.collect_list("term").alias("asked"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                there = expanded(batch.column("terms")[i].as_py()).split()
                place = dict(zip(there, unpacked(expanded(batch.column("df")[i].as_py())).tolist(), strict=True))
                found = [(t, place[b]) for t in batch.column("asked")[i].as_py() if (b := t.encode()) in place]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in found], pa.string()), pa.array([d for _, d in found], pa.int64())], names=["term", "df"])

    met = in_blocks(shards.select("terms", "df"), asked, n)
    return in_batches(met, look, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, equal ones by id."""
    return np.lexsort((ids, -scores))[:k]


def top_documents(shards: DataFrame, asked: DataFrame, terms: int, k: int) -> DataFrame:
    """item, doc_id, score: each task's k best of every item."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                treap = Treap(shard["height"], shard["root"], shard["bits"], shard["drops"])
                place = {t: n for n, t in enumerate(expanded(shard["terms"]).split())}
                ids = np.where(np.frombuffer(expanded(shard["known"]), np.uint8) > 0, np.frombuffer(expanded(shard["ids"]), np.int64), NO_ID)
                for item in shard["asked"]:
                    own = [(place[b], w) for t, w in zip(item["terms"], item["weights"], strict=True) if (b := t.encode()) in place]
                    if not own:
                        continue
                    rows, weights = np.array(own, np.int64).T
                    scores, docs = lists.get(item["item"], (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    search = treap.heaviest(rows, weights, int(scores[-1]) if len(scores) == k else 1)
                    try:
                        columns, sums = next(search)
                        while True:
                            scores, docs = np.concatenate([scores, sums]), np.concatenate([docs, ids[columns]])
                            keep = best(scores, docs, k)
                            scores, docs = scores[keep], docs[keep]
                            columns, sums = search.send(int(scores[-1]) if len(scores) == k else 1)
                    except StopIteration:
                        lists[item["item"]] = scores, docs
        for item, (scores, docs) in lists.items():
            ids = pa.array([None if d == NO_ID else d for d in docs.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([item] * len(docs), pa.int64()), ids, pa.array(scores)], names=["item", "doc_id", "score"])

    return in_batches(in_blocks(shards, asked, terms), look, "item long, doc_id long, score long")


def ranked(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best of ``documents`` (doc_id, text) for each of ``items`` (item_id, text)."""
    n, total = sizes(documents)
    numbered = stored(items.select("item_id", F.array_distinct(words(F.col("text"))).alias("terms")).withColumn("item", F.monotonically_increasing_id()), "items")
    shards = index(documents, n, total or 1)
    each = numbered.select("item", F.explode("terms").alias("term"))
    df = frequencies(shards, each.select("term").distinct())
    weight = F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = stored(each.join(df, "term").select("item", "term", weight.alias("weight")).where("weight > 0"), "weights")
    terms = weighed.count()
    whole = weighed.groupBy("item").agg(F.collect_list(F.struct("term", "weight")).alias("own"))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks_for(terms))).cast("int")
    asked = whole.groupBy(block.alias("block")).agg(
        F.collect_list(F.struct("item", F.col("own.term").alias("terms"), F.col("own.weight").alias("weights"))).alias("asked")
    )
    found = top_documents(shards, asked, terms, k)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    first = found.withColumn("rank", place).where(F.col("rank") <= k)
    out = stored(first.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score"), "ranked")
    for made in (numbered, shards, weighed):
        forget(made)
    return out


def op12_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w FROM documents),
b AS (
  SELECT item_id, row_number() OVER () AS item, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[0-9a-z\x{80}-\x{10FFFF}]+')) AS w FROM benchmark),
s AS (SELECT count(*) AS nn, CAST(sum(len(w)) AS BIGINT) AS ll FROM d WHERE len(w) > 0),
q AS (SELECT item_id, item, unnest(w) AS t FROM b),
p AS (SELECT row, doc_id, n, t, count(*) AS tf FROM (SELECT row, doc_id, len(w) AS n, unnest(w) AS t FROM d) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM p, s WHERE t IN (SELECT t FROM q) GROUP BY t, nn),
r AS (
  SELECT item, item_id, row, doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN f USING (t) JOIN p USING (t), s GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
  FROM r WHERE score > 0) WHERE rank <= 10
"""
