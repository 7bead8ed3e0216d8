"""Benchmark decontamination by winnowing.

Of all k-grams of a text, those are fingerprints whose hash is the least in some run of w
neighbouring k-grams.  With k + w - 1 = 10, two texts that share ten words in a row share at
least one fingerprint inside them.  Documents' fingerprints are joined with the benchmark's;
around each hit the windows of ten words that contain it are compared word by word, so the
result is exact.  An item of fewer than ten words is one window of that length, looked up
with k as long as the window and w = 1.

Only built-in column functions run.  Documents are fingerprinted in one pass for all lengths of
items; when the benchmark's fingerprints are few by count they are broadcast, otherwise both sides
are shuffled by fingerprint.  What leaves that pass is one row for each document and one for
each hit.  A second pass compares the windows of those texts that were hit; other texts are not moved
while the hit ones are few by count.

A null text has no words; a document without words is not contaminated.  Null item ids are
not counted as items.  Every row of ``documents`` has a row, also where ids or whole rows repeat;
inside, rows are known by 128 bits of their id and text.  Extra columns are ignored.  With an empty
benchmark nothing is hit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import Scratch, lower_ascii, small, stored, table

WINDOW = 10
GRAM = 4
#: Bits of a code that hold the position; more words than this do not fit into one string.
POSITION_BITS = 30
#: Rows that one explode makes of equal documents.
COPIES = 10_000
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z; none for null."""
    return F.coalesce(F.array_remove(F.split(lower_ascii(text), NOT_WORD), ""), F.array().cast("array<string>"))


def document_key() -> Column:
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(1), "text", "doc_id").alias("b"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, evaluated once and kept as an object.

    A column handed on from one projection to the next is copied whole at every slice of it,
    which makes a sliding window cost the square of the text's length.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def gram_and_run(length: int) -> tuple[int, int]:
    """k and w for windows of ``length`` words."""
    return (GRAM, WINDOW - GRAM + 1) if length == WINDOW else (length, 1)


def codes(w: Column, length: int) -> Column:
    """One code per fingerprint of the words ``w``: hash bits above, position below.

    The runs at the end of a text, which are shorter, give a few codes more than needed.
    """
    low = (1 << POSITION_BITS) - 1
    k, run = gram_and_run(length)

    def gram(x: Column, i: Column) -> Column:
        h = F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)], F.lit(length))
        return h.bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long"))

    def least(grams: Column) -> Column:
        return F.array_distinct(F.transform(grams, lambda x, i: F.least(x, *[F.get(grams, i + j) for j in range(1, run)])))

    grams = F.transform(w, gram)
    return let(grams, least) if run > 1 else grams


def positions(docs: DataFrame, items: DataFrame, lengths: list[int], scratch: Scratch) -> DataFrame:
    """key, doc_id, n_words, copies and the positions of fingerprints of an item, each with its lengths of windows.

    One row for each different document.
    """
    low = F.lit((1 << POSITION_BITS) - 1)
    theirs = None
    for length in lengths:
        own = items.where(F.size("words") >= WINDOW if length == WINDOW else F.size("words") == length)
        marks = own.select(F.explode(codes(F.col("words"), length)).alias("code")).select(F.shiftright("code", POSITION_BITS).alias("mark"), F.lit(length).alias("length"))
        theirs = marks if theirs is None else theirs.unionByName(marks)
    known = scratch(theirs.groupBy("mark").agg(F.collect_set("length").alias("lengths")), "item-marks")
    seen = let(words(F.col("text")), lambda x: F.struct(F.size(x).alias("n_words"), F.concat(*[codes(x, n) for n in lengths]).alias("codes")))
    each = docs.select("key", "doc_id", seen.alias("seen")).select(
        "key", "doc_id", F.col("seen.n_words").alias("n_words"), F.posexplode_outer("seen.codes").alias("nth", "code")
    )
    begin = F.col("nth").isNull() | (F.col("nth") == 0)
    met = each.withColumn("mark", F.shiftright("code", POSITION_BITS)).join(small(known), "mark", "left").where(F.col("lengths").isNotNull() | begin)
    at = F.when(F.col("lengths").isNotNull(), F.struct("lengths", F.col("code").bitwiseAND(low).cast("int").alias("at")))
    return met.groupBy("key", "doc_id", "n_words").agg(F.collect_set(at).alias("positions"), F.count_if(begin).alias("copies"))


def around(length: int, w: Column) -> Column:
    """start, length and text of every window of the words ``w`` that holds one of the ``positions`` of its length."""
    back, last = length - gram_and_run(length)[0], F.size(w) - length
    own = F.sort_array(F.transform(F.filter("positions", lambda p: F.array_contains(p["lengths"], length)), lambda p: p["at"]))
    starts = F.transform(own, lambda p: F.sequence(F.least(F.greatest(p - back, F.lit(0)), last), F.least(p, last)))
    window = lambda s: F.array_join(F.slice(w, s + 1, length), " ")
    found = F.transform(F.array_distinct(F.flatten(starts)), lambda s: F.struct(s.alias("start"), F.lit(length).alias("length"), window(s).alias("window")))
    return F.when(last >= 0, found).otherwise(F.array().cast("array<struct<start:int,length:int,window:string>>"))


def verdicts(documents: DataFrame, benchmark: DataFrame, scratch: Scratch) -> DataFrame:
    """key, doc_id, n_words, n_hit, names (of items), copies for each different document."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = scratch(items, "items")
    # At most WINDOW lengths; without items the pass still counts words.
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(WINDOW))).distinct().collect()) or [WINDOW]
    keyed = documents.select(document_key().alias("key"), "doc_id", "text")
    every = scratch(positions(keyed, items, lengths, scratch), "positions")
    hit = every.where((F.size("positions") > 0) & (F.col("n_words") >= lengths[0])).select("key", "positions")
    texts = keyed.drop("doc_id").join(small(hit.select("key")), "key", "left_semi").join(hit, "key").dropDuplicates(["key"])
    found = texts.select("key", F.inline(let(words(F.col("text")), lambda w: F.concat(*[around(n, w) for n in lengths]))))
    whole = F.size("words") - F.least(F.size("words"), F.lit(WINDOW))
    theirs = (
        items.select("item_id", "words", F.least(F.size("words"), F.lit(WINDOW)).alias("length"), F.explode(F.sequence(F.lit(1), whole + 1)).alias("start"))
        .select("item_id", F.array_join(F.slice("words", F.col("start"), F.col("length")), " ").alias("window"))
        .distinct()
    )
    hits = found.join(theirs, "window").groupBy("key").agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))

    def cover(done: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        new = F.greatest(end - F.greatest(span["start"], done["end"]), F.lit(0))
        return F.struct(F.greatest(end, done["end"]).alias("end"), (done["sum"] + new).alias("sum"))

    judged = hits.select("key", F.aggregate("spans", zero, cover, lambda x: x["sum"]).cast("long").alias("hit"), "items")
    return every.join(judged, "key", "left").select(
        "key", "doc_id", F.col("n_words").cast("long").alias("n_words"), F.coalesce("hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("names"), "copies",
    )


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of ``documents``."""
    judged = verdicts(documents, benchmark, Scratch())
    # Equal rows come out as often as they went in, spread in two steps.
    parts = judged.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))))
    rows = parts.withColumn("nth", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col("copies") - F.col("part") * COPIES).cast("int"))))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("names").cast("long").alias("n_items"),
        F.sha2(F.array_join("names", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def contaminated_keys(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``key`` (see document_key) of each different document that holds a window of the benchmark."""
    scratch = Scratch()
    found = verdicts(documents, benchmark, scratch).where("n_hit > 0").select("key")
    keys = stored(found, "contaminated")
    scratch.clear()
    return keys


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bs AS (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM bl),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM bs),
dl AS (SELECT row, w, n FROM d, (SELECT DISTINCT n FROM bl) WHERE len(w) >= n),
ds AS (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM dl),
dw AS (SELECT row, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM ds),
h AS (SELECT row, s, n, item_id FROM dw JOIN bw USING (n, g)),
p AS (SELECT row, count(DISTINCT q) AS hit FROM (SELECT row, unnest(range(s, s + n)) AS q FROM h) GROUP BY row),
i AS (SELECT row, count(*) AS items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
      FROM (SELECT DISTINCT row, item_id FROM h) GROUP BY row)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(p.hit, 0) AS n_hit, coalesce(i.items, 0) AS n_items,
       coalesce(i.sha, sha256('')) AS items_sha256, coalesce(p.hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (row) LEFT JOIN i USING (row)
"""
