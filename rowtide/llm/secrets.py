"""Secret scans: fixed patterns, and a likelihood ratio of two character models.

Two first-order Markov models over characters, one of random strings and one of ordinary
identifiers, are counted from labelled samples.  A run of token characters is a secret
when the first model explains it better than the second, by ``threshold`` nats in all and
``per_character`` on average.  Matches of the fixed patterns always stay.

Only built-in functions run.  Training is one aggregation over two bounded samples and sends
at most 2 x 128 x 128 counts to the driver.  Scanning is one pass without a shuffle: pieces
between matches give the positions, so a text is read once for each pattern it contains.

Null and empty texts have no spans.  Spans are counted in code points, the end is exclusive.
Rows are scanned one by one: repeated rows get equal results; extra columns stay.  Without
samples both models are uniform and only the fixed patterns report.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import table

#: The fixed patterns: kind, pattern, and the group and length that a match must have (fixed values).
PATTERNS = (
    ("assign", r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    ("access", r"AKIA[A-Z0-9]{16,}"),
    ("hex", r"[0-9a-f]{24,}"),
)
VALUE = 6
#: Runs that the models judge; a run starts where no such character stands before.
RUN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{VALUE},}}"
#: Runs that are ordinary identifiers in texts without a pattern's match.
WORD = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{8,}"
MARK = "<secret>"
NO_SPANS = "array<struct<kind:string,start:int,end:int>>"


def values(text: Column) -> Column:
    """What the fixed patterns find: the values of assignments, keys, hex runs."""
    found = [F.regexp_extract_all(text, F.lit(p), F.lit(1 if kind == "assign" else 0)) for kind, p in PATTERNS]
    return F.filter(F.concat(*found), lambda v: F.length(v) >= VALUE)


def samples(docs: DataFrame, bound: int = 20_000) -> DataFrame:
    """(value, label): secrets known by pattern (1), identifiers of texts without any (0).

    About ``bound`` documents are looked at for each label, chosen by the hash of the id.
    """
    known = F.col("text").rlike("|".join(f"(?:{p})" for _, p in PATTERNS))
    rows = docs.select("doc_id", "text", F.coalesce(known, F.lit(False)).alias("known"))
    # Two counts.
    counts = {r["known"]: r["n"] for r in rows.groupBy("known").agg(F.count("*").alias("n")).collect()}
    spread = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    parts = []
    for label, found in ((1, values(F.col("text"))), (0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))):
        share = min(1.0, bound / max(1, counts.get(bool(label), 0)))
        part = rows.where((F.col("known") == bool(label)) & (spread < share))
        parts.append(part.select(F.explode(found).alias("value"), F.lit(label).alias("label")))
    return parts[0].unionByName(parts[1])


def fit(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of each pair of ASCII characters (row by row), from (value, label)."""
    pair = lambda i: F.ascii(F.substring("value", i, 1)) * 128 + F.ascii(F.substring("value", i + 1, 1))
    pairs = labelled.where(F.length("value") > 1).select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), pair)).alias("pair"))
    counts = [[[0] * 128 for _ in range(128)] for _ in range(2)]
    for r in pairs.where("pair < 16384").groupBy("label", "pair").agg(F.count("*").alias("n")).collect():
        counts[r["label"]][r["pair"] // 128][r["pair"] % 128] = r["n"]
    # A pair backs off to how often its second character is met at all.
    chance = []
    for label in (0, 1):
        single = [sum(row[b] for row in counts[label]) + 0.5 for b in range(128)]
        every = sum(single)
        chance.append([[(n + 8 * single[b] / every) / (sum(row) + 8) for b, n in enumerate(row)] for row in counts[label]])
    ratio = [math.log(chance[1][a][b] / chance[0][a][b]) for a in range(128) for b in range(128)]
    return ratio


def matches(text: Column, kind: str, pattern: str, keep) -> Column:
    """Spans of those matches of ``pattern`` that ``keep`` admits by text and group 1."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(NO_SPANS).alias("out"))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if kind == "assign" else F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.arrays_zip(
        F.slice(F.split(text, pattern, -1), 1, F.size(group)).alias("piece"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), group.alias("value")
    )

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        span = F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(keep(x["value"]), F.concat(done["out"], span)).otherwise(done["out"]).alias("out"))

    spans = F.aggregate(found, empty, step, lambda x: x["out"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(NO_SPANS))


def scan(docs: DataFrame, ratio: list[float], threshold: float = 8.0, per_character: float = 0.15) -> DataFrame:
    """``docs`` plus ``base`` and ``added``: arrays of (kind, start, end), each in order of start.

    Columns of ``docs`` that have these names are replaced.
    """
    text = F.coalesce("text", F.lit(""))
    table_ = F.split(F.lit(",".join(f"{x:.4f}" for x in ratio)), ",").cast("array<double>")

    def score(value: Column) -> Column:
        pair = lambda i: F.get(table_, F.ascii(F.substring(value, i, 1)) * 128 + F.ascii(F.substring(value, i + 1, 1)))
        return F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), lambda sum_, i: sum_ + pair(i))

    rank = lambda s: F.struct(s["start"].alias("start"), F.when(s["kind"] == "assign", 0).when(s["kind"] == "access", 1).otherwise(2).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))
    fixed = [matches(text, kind, p, lambda v, kind=kind: F.length(v) >= VALUE if kind == "assign" else F.lit(True)) for kind, p in PATTERNS]
    ordered = F.transform(F.array_sort(F.transform(F.concat(*fixed), rank)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    judged = matches(text, "random", RUN, lambda v: score(v) >= F.greatest(F.lit(threshold), F.length(v) * per_character))
    with_base = docs.withColumn("base", ordered).withColumn("added", judged)
    # A run that a fixed pattern found only in part stays whole.
    beyond = lambda r: ~F.exists("base", lambda b: (b["start"] <= r["start"]) & (r["end"] <= b["end"]))
    return with_base.withColumn("added", F.filter("added", beyond))


def redacted(raw: Column, spans: Column) -> Column:
    """A text with every span replaced by a mark; overlapping spans become one."""
    text = F.coalesce(raw, F.lit(""))
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(MARK))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    whole = F.aggregate(ordered, begin, step, lambda d: F.concat(d["out"], F.substring(text, d["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(raw)


def described(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op2_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, fit(samples(docs)))
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.concat("base", "added")
    order = F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), F.array_position(F.array(*map(F.lit, ("assign", "access", "hex", "random"))), s["kind"]).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return found.select(
        "doc_id", n("assign"), n("access"), n("hex"),
        F.sha2(described(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        described(order).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )
