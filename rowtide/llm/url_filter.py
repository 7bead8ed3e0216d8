"""URL verdicts by rules and a cascade of Bloom filters.

A cascade answers exactly, for every key of a known universe, whether the key is listed:
level 0 encodes the listed keys, level 1 the other keys that pass level 0, level 2 the listed
keys that pass level 1, and so on until nothing passes wrongly.  A probe walks the levels and
stops at the first that it does not pass; it needs no join.

Only built-in functions run.  Each level is one aggregation that sets bits; the words of the
bit set come to the driver and become a constant of the plan.  The universe is cut into
shards by key hash with at most ``SHARD_KEYS`` listed keys on average, so a constant's size is bounded
whatever the list; the pages of each shard are judged with that shard's cascade.

A null url, or one without ``://``, has empty host and path.  A key outside the universe may
be answered wrongly; the query's universe holds every host of its pages.  Repeated rows get
equal results; extra columns are ignored; an empty list lists nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import forget, lower_ascii, stored, table

SHARD_KEYS = 100_000
#: Verdict, host and path of each rule (fixed values).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Host labels of the sample block list (fixed values).
LISTED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host, and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


@dataclass
class Level:
    """One Bloom filter: ``words`` of 64 bits as a constant, ``bits`` and ``hashes``."""

    number: int
    words: Column
    bits: int
    hashes: int

    def passes(self, key: Column) -> Column:
        tests = [F.getbit(F.get(self.words, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in places(key, self.number, self.bits, self.hashes)]
        return reduce(lambda a, b: a & b, tests)


def places(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 100 + i)), F.lit(bits)) for i in range(hashes)]


def level_of(keys: DataFrame, count: int, wrong: float, number: int) -> Level:
    """A filter over ``keys`` (key) that other keys pass with probability about ``wrong``."""
    hashes = max(1, round(-math.log2(wrong)))
    bits = max(64, math.ceil(count * -math.log2(wrong) / math.log(2)))
    at = keys.select(F.explode(F.array(*places(F.col("key"), number, bits, hashes))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))
    words = at.groupBy(F.floor(F.col("p") / 64).alias("w")).agg(F.bit_or(bit).alias("v"))
    # bits / 64 rows.
    got = dict(map(tuple, words.collect()))
    text = ",".join(str(got.get(w, 0)) for w in range(-(-bits // 64)))
    return Level(number, F.split(F.lit(text), ",").cast("array<bigint>"), bits, hashes)


def cascade(universe: DataFrame) -> list[Level]:
    """Levels over ``universe`` (key, listed: boolean), in which each key stands once."""
    inside = universe.where("listed").select("key")
    outside = universe.where("not listed").select("key")
    levels: list[Level] = []
    n, others = inside.count(), outside.count()
    while n:
        wrong = min(0.5, max(1e-9, math.sqrt(0.5) * n / others)) if not levels and others else 0.5
        levels.append(level_of(inside, n, wrong, len(levels)))
        inside, outside = outside.where(levels[-1].passes(F.col("key"))), inside
        n = inside.count()
    return levels


def listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    if not levels:
        return F.lit(False)
    answer = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        answer = F.when(level.passes(key), answer).otherwise(F.lit(level.number % 2 == 1))
    return F.coalesce(answer, F.lit(False))


def judge(pages: DataFrame, is_listed: Column, rules=RULES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """page_id, host, path, rule, verdict of each page; ``is_listed`` tells listed hosts by column ``host``."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    universe = stored(parsed.groupBy("host").count().select(F.col("host").alias("key"), is_listed.alias("listed")), "hosts")
    count = universe.where("listed").count()
    shards = max(1, math.ceil(count / shard_keys))
    first = F.lit(None).cast("string")
    verdict = F.lit(None).cast("string")
    for decision, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        first, verdict = F.when(fits, h + p).otherwise(first), F.when(fits, decision).otherwise(verdict)
    parts = []
    for shard in range(shards):
        mine = lambda c, shard=shard: F.pmod(F.xxhash64(c), F.lit(shards)) == shard
        levels = cascade(universe.where(mine("key")))
        method = F.when(listed(levels, F.col("host")), "block").otherwise("allow")
        parts.append(
            (parsed.where(mine("host")) if shards > 1 else parsed).select(
                "page_id", "host", "path", first.alias("rule"), F.coalesce(verdict, method).alias("verdict")
            )
        )
    forget(universe)
    return reduce(DataFrame.unionByName, parts)


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    labels = F.array(*map(F.lit, LISTED_LABELS))
    return judge(table(spark, sf_dir, "pages"), F.arrays_overlap(F.split("host", r"\."), labels))


OP3_SQL = r"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
j AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR suffix(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN list_has_any(string_split(host, '.'), ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])
    THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""
