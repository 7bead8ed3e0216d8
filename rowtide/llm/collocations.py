"""Phrase collocations by vertical partitioning of a truncated suffix tree.

Every word of a piece begins a suffix, cut after MOST words or at the end of its piece.  The
counts of all phrases are the leaf totals under the nodes of the tree of these suffixes.

1. *Words.*  Tasks count words by language; what is below the least count cannot be part of a
   phrase, so suffixes end before such a word.  Words stand as 64-bit hashes from here on; that
   no two words share one is checked over the whole vocabulary, with another seed if they do.
2. *Vertical partition.*  A pass counts the two-word prefixes of suffixes in hashed buckets.  A
   bucket below the least count holds no phrase.  Buckets are put together into groups of
   suffixes that fit the memory budget; those that alone exceed it are split by prefixes of
   three words in a further pass over the texts, then of four and of five.
3. *Subtrees.*  Each block of texts combines its equal suffixes and sends them to their groups.
   A group sorts its suffixes and reads the phrases of each depth from the totals of its
   leaves, independently of all other groups.  Phrases shorter than the prefix of their group
   are added up over groups.
4. *Scores.*  Joins of phrases with the counts of their parts; decimals, so products are exact.

Words, prefixes and phrases of a language with a third of all rows are spread like any other.
To the driver come a filter of the frequent words of FILTER_BITS bits at most, and BUCKETS
totals; both are lossless filters of bounded size, which let more through when the corpus grows.

Null text is empty; null lang is ``und``.  Repeated rows count as often as they occur; ids and
extra columns are not read.  A text of any length is read in slices.  An empty table, or no
phrase that is frequent enough, gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import Index, forget, mix, stored, table
from rowtide.llm.jaccard import packed, unpacked

#: Words of a phrase at most.
MOST = 5
#: Tokens of a block of texts, and suffixes of a group.
BLOCK_TOKENS = 1_000_000
BUDGET = 500_000
#: Counted buckets of prefixes, and how many travel together.
BUCKETS = 1 << 22
CHUNK = 1 << 16
FILTER_BITS = 1 << 27
#: Bytes of one text that are split at once.
SLICE = 4_000_000

# Pieces end at . , ; : ! ? and at U+000A to U+000D; words at space and tab.
END = b"\xff"
SPLIT = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + b".,;:!?\n\x0b\x0c\r" + b"\t",
    b"abcdefghijklmnopqrstuvwxyz" + END * 10 + b" ",
)
GAP = re.compile(rb"[\x09-\x0D ]")
ODD = np.uint64(0x9E3779B97F4A7C15)


def slices(text: bytes) -> Iterator[bytes]:
    """``text`` in parts that end at white space."""
    start = 0
    while len(text) - start > SLICE and (gap := GAP.search(text, start + SLICE)):
        yield text[start : gap.start() + 1]
        start = gap.start() + 1
    yield text[start:]


@dataclass
class Block:
    """Tokens of some texts: token numbers, language of each, and how many of them are counted.

    Tokens behind ``limit`` only follow counted ones; they come again in the next block.
    """

    words: list[bytes]
    ids: np.ndarray
    langs: list[str]
    lang: np.ndarray
    limit: int

    def hashes(self, seed: int) -> np.ndarray:
        """A hash for each token, of its word and language."""
        own = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in self.words), np.uint64, len(self.words))
        theirs = np.fromiter((xxhash.xxh64_intdigest(x.encode(), seed + 1) for x in self.langs), np.uint64, len(self.langs))
        h = mix(own[self.ids] * ODD + theirs[self.lang])
        # 0 stands behind the end of a suffix.
        h[h == 0] = 1
        return h


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """The texts (columns lang, text) as blocks of tokens; END stands behind each piece."""
    index, langs, parts, owners = Index(), Index(), [], []
    index[END]
    size = 0

    def made(limit: int) -> Block:
        lengths = np.array([len(p) for p in parts])
        return Block(list(index), np.concatenate(parts), list(langs), np.repeat(np.array(owners, np.int32), lengths), limit)

    for batch in batches:
        for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist(), strict=True):
            owner = langs[lang]
            for part in slices((text or b"") + END):
                words = part.translate(SPLIT).replace(END, b" \xff ").split()
                parts.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
                owners.append(owner)
                size += len(words)
                if size >= BLOCK_TOKENS:
                    block = made(size - MOST + 1)
                    yield block
                    rest, whose = block.ids[block.limit :], block.lang[block.limit :]
                    index, fresh = Index(), Index()
                    index[END]
                    parts = [np.array([index[block.words[i]]], np.int32) for i in rest.tolist()]
                    owners = [fresh[block.langs[i]] for i in whose.tolist()]
                    langs, size = fresh, len(parts)
                    owner = langs[lang]
    if size:
        yield made(size)


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """h, lang, word, f for every word of every language; ``clash`` where two share h."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            n = len(block.words)
            pair, first, f = np.unique(block.lang[: block.limit].astype(np.int64) * n + block.ids[: block.limit], return_index=True, return_counts=True)
            word = pair % n != 0
            pair, first, f = pair[word], first[word], f[word]
            at = pa.array([block.langs[i] for i in (pair // n).tolist()], pa.string())
            own = pa.array([block.words[i] for i in (pair % n).tolist()], pa.binary()).cast(pa.string())
            h = block.hashes(seed)[first].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), at, own, pa.array(f.astype(np.int64))], names=["h", "lang", "word", "f"])

    each = texts.mapInArrow(count, "h long, lang string, word string, f long")
    name = F.struct("lang", "word")
    return each.groupBy("h").agg(F.sum("f").alias("f"), F.min(name).alias("own"), F.max(name).alias("other")).select(
        "h", "own.lang", "own.word", "f", (F.col("own") != F.col("other")).alias("clash")
    )


class Filter:
    """Which word hashes are frequent; a few others pass too."""

    def __init__(self, frequent: DataFrame):
        bits = 64
        while bits < min(16 * frequent.count(), FILTER_BITS):
            bits *= 2
        at = F.col("h").bitwiseAND(F.lit(bits - 1))
        one = F.expr("shiftleft(1L, cast(at & 63 as int))")
        # At most FILTER_BITS / 64 rows.
        got = frequent.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("cell")).agg(F.bit_or(one).alias("bits")).toArrow()
        self.cells, self.mask = np.zeros(bits // 64, np.uint64), np.uint64(bits - 1)
        self.cells[got["cell"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        at = h & self.mask
        return (self.cells[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


#: What a table of buckets says instead of a group.
RARE, SPLIT_ON = -1, -2


class Partition:
    """Groups of prefixes: for depth 2, 3, ... the group of each bucket, or RARE, or SPLIT_ON."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []
        self.groups = 0

    @property
    def depth(self) -> int:
        """Words of the prefixes that are counted next."""
        return len(self.levels) + 2

    def add(self, totals: np.ndarray, least: int, budget: int) -> bool:
        """Put the buckets of the next depth into groups; whether some must be split further."""
        heavy = (totals > budget) & (self.depth < MOST)
        # No phrase reaches the least count in a bucket below it; longer prefixes add to shorter phrases.
        kept = (totals >= (least if self.depth == 2 else 1)) & ~heavy
        before = np.cumsum(np.where(kept, totals, 0)) - np.where(kept, totals, 0)
        level = np.where(kept, self.groups + before // budget, np.where(heavy, SPLIT_ON, RARE)).astype(np.int32)
        self.groups = max(self.groups, int(level.max()) + 1)
        self.levels.append(level)
        return bool(heavy.any())


def bucket(code: np.ndarray) -> np.ndarray:
    return (mix(code) & np.uint64(BUCKETS - 1)).astype(np.int64)


def suffixes(block: Block, seed: int, known: Filter, partition: Partition) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each suffix of two words or more: its words (0 behind its end), its group, the depth of the group's prefix, its code.

    Suffixes whose group is not known yet have the group SPLIT_ON.
    """
    h = block.hashes(seed)
    good = known(h) & (block.ids != 0)
    after = np.append(h[1:], np.uint64(0))
    code = h * ODD + after
    pair = good & np.append(good[1:], False)
    if partition.levels:
        pair[pair] = partition.levels[0][bucket(code[pair])] != RARE
    at = np.flatnonzero(pair[: block.limit])
    own = np.zeros((len(at), MOST), np.uint64)
    own[:, 0] = h[at]
    run = np.ones(len(at), bool)
    last = len(h) - 1
    for d in range(1, MOST):
        run &= pair[np.minimum(at + d - 1, last)] & (at + d <= last)
        own[run, d] = h[at[run] + d]
    code = code[at]
    group, depth = np.full(len(at), SPLIT_ON, np.int32), np.full(len(at), 2, np.int32)
    for d, level in enumerate(partition.levels, 2):
        open_ = group == SPLIT_ON
        if d > 2:
            code[open_] = mix(code[open_]) * ODD + own[open_, d - 1]
        group[open_], depth[open_] = level[bucket(code[open_])], d
    open_ = group == SPLIT_ON
    if partition.levels:
        code[open_] = mix(code[open_]) * ODD + own[open_, min(partition.depth, MOST) - 1]
    return own, group, depth, code


def prefix_totals(texts: DataFrame, seed: int, known: Filter, partition: Partition) -> np.ndarray:
    """How many suffixes without a group begin with the prefixes of each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(BUCKETS, np.int64)
        for block in blocks(batches):
            _, group, _, code = suffixes(block, seed, known, partition)
            totals += np.bincount(bucket(code[group == SPLIT_ON]), minlength=BUCKETS)
        for chunk in range(0, BUCKETS, CHUNK):
            part = totals[chunk : chunk + CHUNK]
            if part.any():
                most = np.minimum(part, (1 << 32) - 1)
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([packed(most)], pa.binary())], names=["chunk", "totals"])

    def add_up(got: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for part in got["totals"].to_pylist():
            total += unpacked(part)
        return pa.table({"chunk": got["chunk"][:1], "totals": pa.array([total.tobytes()], pa.binary())})

    form = "chunk long, totals binary"
    totals = np.zeros(BUCKETS, np.int64)
    # BUCKETS numbers.
    for row in texts.mapInArrow(count, form).groupBy("chunk").applyInArrow(add_up, form).collect():
        totals[row["chunk"] : row["chunk"] + CHUNK] = np.frombuffer(row["totals"], np.int64)
    return totals


def send(seed: int, known: Filter, partition: Partition):
    """Blocks of texts to messages: a group, the words it needs, and the different suffixes with their counts."""

    def message(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            own, group, depth, _ = suffixes(block, seed, known, partition)
            own, group, depth = own[group >= 0], group[group >= 0], depth[group >= 0]
            if not len(group):
                continue
            words, ids = np.unique(own, return_inverse=True)
            ids = ids.reshape(own.shape)
            # A block has fewer than 2 ** 21 different words, so three numbers fit one key.
            wide = [np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)]
            for d in range(MOST):
                wide[d // 3] = wide[d // 3] * len(words) + ids[:, d]
            order = np.lexsort((wide[1], wide[0], group))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(wide[0][order]) != 0) | (np.diff(wide[1][order]) != 0) | (np.diff(group[order]) != 0)
            starts = np.flatnonzero(new)
            counts = np.diff(starts, append=len(order))
            order = order[starts]
            ids, group, depth = ids[order], group[order], depth[order]
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                used, local = np.unique(ids[a:b], return_inverse=True)
                row = {"group": int(group[a]), "depth": int(depth[a]), "words": words[used].tobytes(), "ids": packed(local.reshape(-1, MOST).T.ravel()), "counts": packed(counts[a:b])}
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("group", pa.int32()), ("depth", pa.int32()), ("words", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary())]))

    return message


MESSAGE = "group int, depth int, words binary, ids binary, counts binary"


def subtree(least: int):
    """The phrases of one group, from the leaf totals of its sorted suffixes."""

    def build(got: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in got["words"].to_pylist()]
        every = np.unique(np.concatenate([np.zeros(1, np.uint64), *words]))
        parts = []
        for own, ids in zip(words, got["ids"].to_pylist(), strict=True):
            parts.append(np.searchsorted(every, own)[unpacked(ids)].reshape(MOST, -1).T)
        ids = np.concatenate(parts)
        counts = np.concatenate([unpacked(c) for c in got["counts"].to_pylist()]).astype(np.int64)
        order = np.lexsort(ids.T[::-1])
        ids, counts = ids[order], counts[order]
        new = np.zeros(len(ids), bool)
        new[0] = True
        depth, phrases, totals = got["depth"][0].as_py(), [], []
        for d in range(1, MOST + 1):
            new[1:] |= np.diff(ids[:, d - 1]) != 0
            if d == 1:
                continue
            starts = np.flatnonzero(new)
            total = np.add.reduceat(counts, starts)
            keep = (ids[starts, d - 1] != 0) & ((total >= least) | (d < depth))
            phrases += every[ids[starts[keep], :d]].view(np.int64).tolist()
            totals.append(total[keep])
        return pa.table({"ids": pa.array(phrases, pa.list_(pa.int64())), "f": pa.array(np.concatenate(totals))})

    return build


def phrase_counts(texts: DataFrame, seed: int, frequent: DataFrame, least: int, budget: int = BUDGET) -> DataFrame:
    """ids (hashes of the words), f of every phrase of two to MOST words that occurs ``least`` times or more."""
    known, partition = Filter(frequent), Partition()
    while partition.add(prefix_totals(texts, seed, known, partition), least, budget):
        pass
    sent = texts.mapInArrow(send(seed, known, partition), MESSAGE)
    found = sent.groupBy("group").applyInArrow(subtree(least), "ids array<long>, f long")
    return found.groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def ratio(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exactly."""
    wide = lambda c: c.cast("decimal(19,0)")
    product, parts = wide(1000 * a) * wide(n), wide(left) * wide(right)
    return F.call_function("div", product, parts)


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of ``docs`` (lang, text)."""
    texts, seed = texts_of(docs), 0
    words = stored(word_counts(texts, seed), "words")
    while not words.where("clash").isEmpty():
        forget(words)
        seed += 2
        words = stored(word_counts(texts, seed), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = stored(words.where(F.col("f") >= least).select("h", "lang", "word", "f"), "frequent")
    phrases = stored(phrase_counts(texts, seed, frequent, least, budget), "phrases")
    size = F.size("ids")
    known = phrases.unionByName(frequent.select(F.array("h").alias("ids"), "f"))
    cut = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("head"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("tail")
    )
    counted = (
        cut.join(known.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head")
        .join(known.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
        .join(frequent.select(F.col("h"), "lang"), F.col("ids")[0] == F.col("h"))
        .join(totals, "lang")
        .withColumn("score", ratio(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    )
    judged = counted.groupBy("ids").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), *[F.first(c).alias(c) for c in ("lang", "a", "n")]
    )
    # A phrase that a longer one covers is covered by one of a single word more, which counts as much.
    longer = phrases.where(size > 2).select("f", F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids"))
    covers = longer.groupBy("ids").agg(F.max("f").alias("cover"))
    left = judged.join(covers, "ids", "left").where(F.coalesce("cover", F.lit(0)) < F.col("a"))
    left = left.select("ids", "lang", "a", "n", "cut.l", "cut.r", "cut.score")
    by = Window.partitionBy("lang")
    first = left.withColumn("place", F.rank().over(by.orderBy(F.desc("score"), F.desc("a")))).where(F.col("place") <= top)
    named = (
        first.select("*", F.posexplode("ids").alias("pos", "h")).join(frequent.select("h", "word"), "h")
        .groupBy("ids", "lang", "a", "n", "l", "r", "score")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    )
    rank = F.row_number().over(by.orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = named.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    out = stored(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    for made in (words, frequent, phrases):
        forget(made)
    return out


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    """Collocations of every language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM d),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, w[i:i + k - 1] AS g, k FROM s, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, g, k, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, g, k AS m, f AS a FROM f WHERE k >= 2 AND f >= 100),
t AS (SELECT lang, g, m, a, unnest(range(1, m)) AS k FROM c),
x AS (
  SELECT t.lang, t.g, t.a, t.k, l.f AS l, r.f AS r, n.n,
         CAST((1000::HUGEINT * t.a * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM t JOIN f l ON l.lang = t.lang AND l.g = t.g[1:t.k] JOIN f r ON r.lang = t.lang AND r.g = t.g[t.k + 1:] JOIN n ON n.lang = t.lang),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
o AS (SELECT lang, g, a, unnest(range(1, m)) AS s, m FROM c),
e AS (SELECT DISTINCT o.lang, o.g[s:s + q - 1] AS g, o.a FROM o, (SELECT unnest(range(2, 5)) AS q) WHERE q < m AND s + q - 1 <= m),
z AS (SELECT y.*, array_to_string(g, ' ') AS phrase FROM y
      WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.lang = y.lang AND e.g = y.g AND 100 * e.a >= 100 * y.a))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z) WHERE rank <= 2000
"""
