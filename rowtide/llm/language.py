"""Language identification as inference of a mixture.

A document is a mixture of languages; each of its words comes from one of them, with a
probability given by that language's character trigrams.  Expectation-maximisation finds the
proportions, and the set of languages grows one by one as long as the likelihood gained is
worth more than a penalty that grows with the document's length.

The model is counted by Spark over a sample of labelled rows, bounded per language, and has
a fixed number of buckets per language.  Scoring is one pass without a shuffle.

Null text, empty text and text without letters give ``und`` with score 0 and no languages.
A null lang is no label.  Ties go to the language first in alphabetical order.  Rows are
scored one by one: repeated rows get equal results, extra columns are ignored, an empty
table gives an empty result; without any labelled row every document is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import WordTable, batches_of, code_points, group_sum, id_crc, mix, words_of

#: Runs of letters; a longer run is cut, so that scripts without spaces have words too.
LETTERS = re.compile(r"[^\W\d_]{1,24}")
BUCKETS = 1 << 16
#: Rounds of EM; the same for every document, so that a result does not depend on its neighbours.
ROUNDS = 15
OUT = "doc_id long, lang_pred string, score double, languages array<string>, proportions array<double>"


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word's trigrams, with two marks before and one after it, and their counts."""
    points, _ = code_points([f"\x02\x02{w}\x03" for w in words])
    counts = np.fromiter(map(len, words), np.int64, len(words)) + 1
    h = points.astype(np.uint64)
    h = mix((h[:-2] << np.uint64(42)) ^ (h[1:-1] << np.uint64(21)) ^ h[2:])
    ends = np.cumsum(counts + 2)
    inside = np.ones(len(points), bool)
    inside[ends - 1] = inside[ends - 2] = False
    return (h[inside[:-2]] & np.uint64(BUCKETS - 1)).astype(np.int64), counts


@dataclass
class LanguageModel:
    """``logs[bucket, language]``: log probability of a trigram; languages in alphabetical order."""

    languages: list[str]
    logs: np.ndarray

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word in each language; the last column says whether it has letters."""
        buckets, counts = trigrams(words)
        alpha = np.fromiter((any(map(str.isalpha, w)) for w in words), np.float32, len(words))
        return np.column_stack([group_sum(self.logs[buckets], counts), alpha]).astype(np.float32)


def fit(docs: DataFrame, keep: Column, per_language: int | None = 4000, smoothing: float = 0.2) -> LanguageModel:
    """Trigram statistics of the rows of ``docs`` (doc_id, text, lang) that ``keep`` admits.

    About ``per_language`` rows of a language with more rows are counted, chosen by the hash of the id;
    with None all rows are.
    """
    known = docs.where(keep & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    # One row per language comes to the driver.
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LanguageModel([], np.zeros((BUCKETS, 0), np.float32))
    languages = sorted(sizes)
    if per_language is not None:
        share = F.create_map(*[x for l, n in sizes.items() for x in (F.lit(l), F.lit(min(1.0, per_language / n)))])
        spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        known = known.where(spread < F.element_at(share, F.col("lang")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch, texts in batches_of(batches):
            by: dict[str, list[str]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                by.setdefault(lang, []).append(text)
            for lang, own in by.items():
                words, _ = words_of(own, LETTERS, lower=True)
                if words:
                    # Most words come again and again.
                    some = Counter(words)
                    buckets, counts = trigrams(list(some))
                    times = np.repeat(np.fromiter(some.values(), np.float64, len(some)), counts)
                    total[lang] = total.get(lang, 0) + np.bincount(buckets, weights=times, minlength=BUCKETS)
        for lang, n in total.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(seen), "bucket": seen.astype(np.int32), "n": n[seen].astype(np.int64)})

    counted = known.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most BUCKETS rows per language.
    got = counted.toArrow()
    n = np.zeros((BUCKETS, len(languages)))
    column = {l: i for i, l in enumerate(languages)}
    if got.num_rows:
        n[got["bucket"].to_numpy(), [column[l] for l in got["lang"].to_pylist()]] = got["n"].to_numpy()
    n += smoothing
    return LanguageModel(languages, np.log(n / n.sum(axis=0)).astype(np.float32))


def proportions(logs: np.ndarray, counts: np.ndarray, sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM for all documents at once: proportions and log-likelihood within each document's set.

    ``logs``: words x languages, ``counts``: words of each document (none empty), ``sets``:
    documents x languages, which languages may take part.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    shifted = np.where(sets[owner], logs, -np.inf)
    top = shifted.max(axis=1, keepdims=True)
    p = np.exp(shifted - top)
    pi = sets / sets.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        joint = p * pi[owner]
        pi = group_sum(joint / joint.sum(axis=1, keepdims=True), counts) / counts[:, None]
    each = np.log((p * pi[owner]).sum(axis=1, keepdims=True)) + top
    return pi, group_sum(each, counts)[:, 0]


def infer(logs: np.ndarray, counts: np.ndarray, penalty: float = 2.0) -> np.ndarray:
    """Proportions of each document, over the set of languages that the penalised likelihood selects."""
    docs, width = len(counts), logs.shape[1]
    owner = np.repeat(np.arange(docs), counts)
    alone = group_sum(logs, counts)
    sets = np.zeros((docs, width), bool)
    sets[np.arange(docs), alone.argmax(axis=1)] = True
    pi, best = sets.astype(float), alone.max(axis=1)
    cost = penalty * np.log(counts + 1.0)
    active = np.arange(docs)
    while len(active) and width > 1:
        inside = np.zeros(docs, bool)
        inside[active] = True
        rows = inside[owner]
        now, own, n = logs[rows], np.repeat(np.arange(len(active)), counts[active]), counts[active]
        have = np.where(sets[active][own], now, -np.inf).max(axis=1)
        gain = np.full((len(active), width), -np.inf)
        tried: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for l in range(width):
            # No mixture gains more than taking the better language for every word.
            bound = group_sum(np.maximum(now[:, l : l + 1] - have[:, None], 0), n)[:, 0] + (
                group_sum(have[:, None], n)[:, 0] - best[active]
            )
            at = np.flatnonzero(~sets[active, l] & (bound > cost[active]))
            if len(at):
                take = np.isin(own, at)
                wider = sets[active[at]].copy()
                wider[:, l] = True
                mixed, likelihood = proportions(now[take], n[at], wider)
                gain[at, l] = likelihood - best[active[at]] - cost[active[at]]
                tried[l] = at, mixed, likelihood
        choice = gain.argmax(axis=1)
        grown = gain[np.arange(len(active)), choice] > 0
        for l, (at, mixed, likelihood) in tried.items():
            use = grown[at] & (choice[at] == l)
            d = active[at[use]]
            sets[d, l], pi[d], best[d] = True, mixed[use], likelihood[use]
        active = active[grown]
    # Sums differ in their last digits with a document's place in a batch.
    return np.round(pi, 9)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score (the proportion of lang_pred), languages and proportions, the largest first."""
    names, width = model.languages, len(model.languages)
    schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())), ("proportions", pa.list_(pa.float64()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTable(model.word_rows)
        for batch, texts in batches_of(batches):
            known.begin()
            words, counts = words_of(texts, LETTERS, lower=True)
            pi = np.zeros((len(texts), width))
            if words and width:
                values = known.ids(words)
                values = known.values[values]
                alpha = values[:, -1] > 0
                counts = group_sum(alpha[:, None].astype(float), counts)[:, 0].astype(np.int64)
                some = counts > 0
                if some.any():
                    pi[some] = infer(values[alpha, :-1].astype(np.float64), counts[some])
            order = np.argsort(-pi, axis=1, kind="stable")
            most = [[(names[l], float(row[l])) for l in at if row[l] > 0] for row, at in zip(pi, order, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([m[0][0] if m else "und" for m in most], pa.string()),
                    pa.array([min(1.0, m[0][1]) if m else 0.0 for m in most], pa.float64()),
                    pa.array([[x for x, _ in m] for m in most], pa.list_(pa.string())),
                    pa.array([[p for _, p in m] for m in most], pa.list_(pa.float64())),
                ],
                schema=schema,
            )

    return docs.select("doc_id", "text").mapInArrow(score, OUT)


def op1_language(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose crc32(doc_id) mod 3 is not 1."""
    from rowtide.llm.common import table

    docs = table(spark, sf_dir, "documents")
    model = fit(docs, id_crc() % 3 != 1)
    held = F.coalesce(id_crc() % 3 == 1, F.lit(False)).alias("held_out")
    return identify(docs, model).select("doc_id", held, "lang_pred", "score", "languages", "proportions")
