"""Toxicity by a convolutional network over hashed words.

Every word is the sum of the hashed embeddings of itself and its beginnings and ending, so that
inflected forms of a word share what is learned.  Filters over one, two and three words are
max-pooled over the whole text, and one layer scores the maxima.  The cut is calibrated for
each language, which is inferred from the text alone.

All labelled rows that are admitted train.  Their word buckets are computed and stored once, in
groups; the embeddings start from how surely a bucket speaks for a label, counted over all rows.
In each pass every group trains a copy of the network in numpy inside its task, Spark adds up
how far the copies went, and the driver moves the network by the mean.  Two more networks, each
from one half of the ids, judge the other half; the cuts follow from the counts of all these
logits, which stand on a grid.  Scoring is one pass without a shuffle over whole texts.

Null and empty texts, and those without words, have no maxima and score what the bias says.
Rows are scored one by one.  Extra columns are ignored.  With an empty table the result is
empty; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm import language
from rowtide.llm.common import WordTable, batches_of, code_points, forget, give_back, group_sum, id_crc, labelled_ids, mix, small, stored, table, words_of
from rowtide.llm.learn import CUT, CUT_LOGIT, Adam, sigmoid, threshold

WORD = re.compile(r"[^\W_]{1,40}")
BUCKETS = 1 << 16
DIMS = 8
FILTERS = 6
WIDTHS = (1, 2, 3)
#: Which parts of a word are hashed beside the whole: so many characters from its start, and its end.
STARTS, END = (3, 4, 5), 4
PARTS = 2 + len(STARTS)
OFFSETS = [(w, o) for w in WIDTHS for o in range(w)]
#: Parameters beside the embeddings.
DENSE = ("C", "b", "u", "c")
#: Labelled rows that train one after the other before models are averaged, and the most such groups; beyond, groups are larger.
GROUP, GROUPS = 4096, 256
#: Passes over all labelled rows, at least and at most; between, as many as bring so many visits to a row.
PASSES, VISITS = (2, 6), 36_000
#: Steps of a parameter are added up as whole numbers of 1 / STEP; logits stand on a grid of 1 / GRID within LIMIT.
STEP, GRID, LIMIT = float(1 << 30), 1024, 40


def buckets_of(words: list[str]) -> np.ndarray:
    """PARTS buckets of each word; bucket 0 stands for a part the word is too short for."""
    points, lengths = code_points(words)
    points = points.astype(np.uint64) + np.uint64(7)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    powers = np.cumprod(np.full(64, 0x100000001B3, np.uint64))
    # Sums up to each place, so that a beginning's is a difference; they wrap around.
    sums = np.append(np.uint64(0), np.cumsum(points * powers[np.arange(len(points)) - np.repeat(starts, lengths)], dtype=np.uint64))
    out = np.zeros((len(words), PARTS), np.int64)
    for kind, size in enumerate((None, *STARTS, END)):
        some = lengths > (size or 0)
        if kind < PARTS - 1:
            h = sums[ends if size is None else np.minimum(starts + size, ends)] - sums[starts]
        else:
            h = np.zeros(len(words), np.uint64)
            for o in range(END):
                h[some] += points[ends[some] - END + o] * powers[o]
        # Beginnings share buckets whatever their length is to the word; endings have their own.
        h = mix(h + np.uint64(kind == PARTS - 1) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(kind == 0) * np.uint64(0x7F4A7C15))
        out[some, kind] = (1 + h[some] % np.uint64(BUCKETS - 1)).astype(np.int64)
    return out


@dataclass
class ToxicityModel:
    """Embeddings ``E``, filters ``C`` (one matrix per offset), filter biases, output layer, cuts by language."""

    params: dict[str, np.ndarray]
    cuts: dict[str, float] = field(default_factory=dict)
    cut: float = 0.0

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        """What each word adds to each filter at each offset."""
        e = self.params["E"]
        sums = e.take(buckets[:, 0], axis=0)
        for p in range(1, buckets.shape[1]):
            sums += e.take(buckets[:, p], axis=0)
        return (sums @ np.concatenate(list(self.params["C"]), axis=1)).astype(np.float32)

    def maps(self, rows: np.ndarray) -> list[np.ndarray]:
        """Filter values at every start; ``rows`` of words followed by padding rows of zeros."""
        n = len(rows) - max(WIDTHS) + 1
        out = []
        for w in WIDTHS:
            at = [OFFSETS.index((w, o)) * FILTERS for o in range(w)]
            own = rows[:n, at[0] : at[0] + FILTERS].copy()
            for o, a in enumerate(at[1:], 1):
                own += rows[o : o + n, a : a + FILTERS]
            out.append(own)
        return out

    def score(self, pooled: np.ndarray) -> np.ndarray:
        logit = np.maximum(pooled + self.params["b"], 0) @ self.params["u"] + self.params["c"][0]
        return np.rint(np.clip(logit, -LIMIT, LIMIT) * GRID) / GRID


def padded(ids: np.ndarray, counts: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word ids with two padding ids after each text, and where each text starts."""
    extra = max(WIDTHS) - 1
    starts = np.cumsum(counts + extra) - (counts + extra)
    out = np.full(int((counts + extra).sum()), pad, np.int64)
    out[np.arange(len(ids)) + np.repeat(starts - (np.cumsum(counts) - counts), counts)] = ids
    return out, starts


def gradients(model: ToxicityModel, texts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """Of the weighted mean cross entropy: by the dense parameters, and by rows of ``E`` (buckets of words, their common step)."""
    params = model.params
    # Every text has at least one start, so its padding takes part like a word without meaning.
    own = [np.concatenate([t, np.zeros((max(WIDTHS), PARTS), np.int64)]) for t in texts]
    buckets = np.concatenate([*own, np.zeros((max(WIDTHS), PARTS), np.int64)])
    maps = model.maps(model.rows(buckets))
    starts = np.cumsum([0, *map(len, own)])
    top = np.array([[s + m[s : s + len(o) - 2].argmax(axis=0) for m in maps] for s, o in zip(starts, own, strict=False)])
    pooled = np.concatenate([m[top[:, k], np.arange(FILTERS)] for k, m in enumerate(maps)], axis=1)
    active = np.maximum(pooled + params["b"], 0)
    d = (sigmoid(active @ params["u"] + params["c"][0]) - labels) * weight / len(labels)
    back = d[:, None] * params["u"] * (active > 0)
    grads = {"C": np.zeros_like(params["C"]), "b": back.sum(axis=0), "u": d @ active, "c": np.array([d.sum()])}
    touched = []
    for n, (w, o) in enumerate(OFFSETS):
        k = WIDTHS.index(w)
        g = back[:, k * FILTERS : (k + 1) * FILTERS]
        where = buckets[top[:, k] + o]
        x = params["E"][where].sum(axis=2)
        grads["C"][n] = np.einsum("tf,tfd->df", g, x)
        dx = g[:, :, None] * params["C"][n].T[None]
        hit = np.flatnonzero(np.abs(g).ravel() > 0)
        touched.append((where.reshape(-1, PARTS)[hit], dx.reshape(-1, DIMS)[hit]))
    return grads, touched


@dataclass
class Training:
    """A model on its way: embeddings with the squares of their steps, dense parameters, and weights of both labels."""

    model: ToxicityModel
    speed: np.ndarray
    weights: np.ndarray

    def __post_init__(self) -> None:
        self.adam = Adam({k: self.model.params[k] for k in DENSE}, 0.01)

    @staticmethod
    def start(seen: np.ndarray, totals: np.ndarray, seed: int = 11) -> Training:
        """From the texts of each label, and those of them that hold a bucket; both labels weigh the same."""
        rng = np.random.default_rng(seed)
        n = np.maximum(totals, 1)
        odds = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        sure = np.clip(odds - 2 / np.sqrt(seen[1] + 0.5), 0, None) - np.clip(-odds - 2 / np.sqrt(seen[0] + 0.5), 0, 3) * 0.2
        e = rng.normal(0, 0.02, (BUCKETS, DIMS))
        e[:, 0] = sure / 4
        e[0] = 0
        params = {
            "E": e.astype(np.float32), "C": rng.normal(0, 0.2, (len(OFFSETS), DIMS, FILTERS)), "b": np.zeros(len(WIDTHS) * FILTERS),
            "u": rng.normal(0, 0.1, len(WIDTHS) * FILTERS), "c": np.array([-2.0]),
        }
        params["C"][:, 0, 0] = 1.0
        params["u"][::FILTERS] = 1.0
        params["b"][::FILTERS] = -0.5
        return Training(ToxicityModel(params), np.zeros(BUCKETS), 0.5 * n.sum() / n)

    def copy(self) -> Training:
        return Training(ToxicityModel({k: v.copy() for k, v in self.model.params.items()}), self.speed.copy(), self.weights)

    def dense(self) -> np.ndarray:
        """All but the embeddings, in rows as wide as those."""
        flat = np.concatenate([self.model.params[k].ravel() for k in DENSE])
        return np.append(flat, np.zeros(-len(flat) % DIMS)).reshape(-1, DIMS)

    def moved(self, start: Training) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the rows that differ from ``start``, embeddings first; how far they and their squares went."""
        e = np.flatnonzero(self.speed != start.speed)
        dense = self.dense() - start.dense()
        steps = np.zeros((len(e) + len(dense), DIMS + 1))
        steps[: len(e), :DIMS] = self.model.params["E"][e].astype(np.float64) - start.model.params["E"][e]
        steps[: len(e), DIMS] = self.speed[e] - start.speed[e]
        steps[len(e) :, :DIMS] = dense
        return np.append(e, BUCKETS + np.arange(len(dense))), steps

    def move(self, rows: np.ndarray, steps: np.ndarray) -> None:
        e = rows < BUCKETS
        self.model.params["E"][rows[e]] += steps[e, :DIMS].astype(np.float32)
        self.speed[rows[e]] += steps[e, DIMS]
        dense = self.dense()
        dense[rows[~e] - BUCKETS] += steps[~e, :DIMS]
        flat, at = dense.ravel(), 0
        for k in DENSE:
            own = self.model.params[k]
            own[...] = flat[at : at + own.size].reshape(own.shape)
            at += own.size

    def learn(self, texts: list[np.ndarray], labels: np.ndarray, batch: int = 32) -> None:
        """One pass over texts given as word buckets (words x PARTS)."""
        e = self.model.params["E"]
        for at in np.array_split(np.arange(len(texts)), max(1, len(texts) // batch)):
            grads, touched = gradients(self.model, [texts[i] for i in at], labels[at].astype(np.float64), self.weights[labels[at]])
            for flat, step in touched:
                squares = (step * step).sum(axis=1)
                for p in range(PARTS):
                    np.add.at(self.speed, flat[:, p], squares)
                    np.add.at(e, flat[:, p], (-0.05 * step / np.sqrt(self.speed[flat[:, p]] + 1e-6)[:, None]).astype(np.float32))
            e[0] = 0
            self.adam.step({k: g + 1e-4 * self.model.params[k] for k, g in grads.items()})


def pooled_of(model: ToxicityModel, ids: np.ndarray, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Maxima of every filter over each text; ``values[id]`` begin with words' rows."""
    at, starts = padded(ids, counts, -1)
    at = np.concatenate([at, np.full(max(WIDTHS), -1)])
    rows = values.take(at, axis=0, mode="wrap") if len(values) else np.zeros((len(at), len(OFFSETS) * FILTERS), np.float32)
    rows[at < 0] = 0
    # A text without words has two padding starts.
    return np.concatenate([np.maximum.reduceat(m, starts) for m in model.maps(rows)], axis=1)


def examples(docs: DataFrame, labels: DataFrame, keep: Column, languages: language.LanguageModel, label: str) -> DataFrame:
    """grp, fold, label, lang and words (buckets as bytes) of every labelled row that ``keep`` admits.

    Stored by groups of about GROUP rows, GROUPS at most, each in a random order of its own.
    """

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTable(lambda words: np.column_stack([buckets_of(words), languages.word_rows(words)]).astype(np.float32))
        for batch, texts in batches_of(batches):
            known.begin()
            words, counts = words_of(texts, WORD, lower=True)
            at = known.ids(words) if words else None
            got = known.values[at] if words else np.zeros((0, PARTS + len(languages.languages) + 1), np.float32)
            buckets = np.split(got[:, :PARTS].astype(np.uint16), np.cumsum(counts)[:-1])
            sums = group_sum(got[:, PARTS:-1], counts)
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in ("grp", "fold", "place", "label")},
                "lang": pa.array([best_language(languages, s) if n else "" for s, n in zip(sums, counts, strict=True)], pa.string()),
                "words": pa.array([b.tobytes() for b in buckets], pa.binary()),
            })

    chosen = stored(labelled_ids(labels, label, keep), "toxicity-labels")
    groups = min(GROUPS, -(-max(1, chosen.count()) // GROUP))
    # One id may stand in many rows, so its rows are dealt by their texts too.
    place, fold = F.xxhash64("doc_id", "text"), F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int")
    rows = docs.select("doc_id", "text").where(keep).join(small(chosen), "doc_id")
    rows = rows.select(F.pmod(F.shiftright(place, 8), F.lit(groups)).cast("int").alias("grp"), fold.alias("fold"), place.alias("place"), "label", "text")
    rows = rows.mapInArrow(features, "grp int, fold int, place long, label int, lang string, words binary")
    rows = stored(rows.repartitionById(groups, F.col("grp")).sortWithinPartitions("grp", "place"), "toxicity-examples", compression="zstd")
    forget(chosen)
    return rows


def texts_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, int, int, str]]:
    """grp, word buckets, label, fold and lang of each example."""
    for batch in batches:
        words = batch.column("words")
        rest = zip(*(batch.column(c).to_pylist() for c in ("grp", "label", "fold", "lang")), strict=True)
        for own, (grp, label, fold, lang) in zip(words, rest, strict=True):
            yield grp, np.frombuffer(own.as_buffer(), np.uint16).reshape(-1, PARTS).astype(np.int64), label, fold, lang


def seen_in(rows: DataFrame) -> np.ndarray:
    """Examples by fold, label and bucket that hold the bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, last = np.zeros((2, 2, BUCKETS), np.int64), np.zeros(BUCKETS, np.int64)
        for _, text, label, fold, _ in texts_of(batches):
            # Of equal buckets one place stays in ``last``.
            text, place = text.ravel(), np.arange(text.size)
            last[text] = place
            seen[fold, label, text[last[text] == place]] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int64()), "n": seen.ravel()[at]})
        give_back()

    # At most 4 x BUCKETS rows.
    got = rows.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(4 * BUCKETS)
    seen[got["at"].to_numpy()] = got["n"].to_numpy()
    return seen.reshape(2, 2, BUCKETS)


def one_pass(rows: DataFrame, models: list[Training], nth: int) -> None:
    """Every group of examples trains the models from where they stand; each row of numbers then moves by the mean of the groups that moved it.

    Model ``k`` learns from the fold that is not ``k``, the last one from all.
    """
    names = [f"v{n}" for n in range(DIMS + 1)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, own in groupby(texts_of(batches), key=lambda r: r[0]):
            now, rng = [m.copy() for m in models], np.random.default_rng((nth, grp))
            while part := list(islice(own, 2048)):
                rng.shuffle(part)
                for k, model in enumerate(now):
                    if mine := [(text, label) for _, text, label, fold, _ in part if fold != k]:
                        model.learn([text for text, _ in mine], np.array([label for _, label in mine]))
            for k, (model, start) in enumerate(zip(now, models, strict=True)):
                if not model.adam.t:
                    continue
                at, steps = model.moved(start)
                # Whole numbers add up to the same sum in any order.
                steps = np.rint(steps * STEP).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"model": np.full(len(at), k, np.int32), "at": at.astype(np.int32), **{c: steps[:, n] for n, c in enumerate(names)}})
        give_back()

    moved = rows.mapInArrow(learn, f"model int, at int, {', '.join(f'{c} long' for c in names)}")
    # As many rows as the models have.
    got = moved.groupBy("model", "at").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in names]).toArrow()
    number, at, n = (got[c].to_numpy() for c in ("model", "at", "n"))
    steps = np.column_stack([got[c].to_numpy() for c in names]) / STEP / n[:, None]
    for k, model in enumerate(models):
        model.move(at[number == k], steps[number == k])


def logits_of(model: ToxicityModel, text: np.ndarray) -> float:
    n = len(text)
    return model.score(pooled_of(model, np.arange(n), model.rows(text), np.array([n])))[0]


def held_out_counts(rows: DataFrame, models: list[ToxicityModel]) -> pa.Table:
    """lang, label, logit and number of all examples, each by the model that has not seen it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter((lang, label, logits_of(models[fold], text)) for _, text, label, fold, lang in texts_of(batches))
        lang, label, logit = zip(*total, strict=True) if total else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.string()), pa.array(label, pa.int32()), pa.array(logit, pa.float64()), pa.array(total.values(), pa.int64())], names=["lang", "label", "logit", "n"]
        )
        give_back()

    # Logits are bounded and stand on a grid, so there are not more rows than its steps for each language and label.
    return rows.mapInArrow(count, "lang string, label int, logit double, n long").groupBy("lang", "label", "logit").agg(F.sum("n").alias("n")).toArrow()


def fit(docs: DataFrame, labels: DataFrame, keep: Column, languages: language.LanguageModel, label: str = "toxic") -> ToxicityModel | None:
    """A model from all labelled rows that ``keep`` admits; None without rows of both labels."""
    rows = examples(docs, labels, keep, languages, label)
    totals = np.zeros((2, 2), np.int64)
    # Four rows.
    for r in rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect():
        totals[r["fold"], r["label"]] = r["n"]
    if not totals.sum(axis=0).all():
        forget(rows)
        return None
    seen = seen_in(rows)
    models = [Training.start(s, n) for s, n in ((seen[1], totals[1]), (seen[0], totals[0]), (seen.sum(axis=0), totals.sum(axis=0)))]
    for nth in range(int(np.clip(-(-VISITS // totals.sum()), *PASSES))):
        one_pass(rows, models, nth)
    held = held_out_counts(rows, [m.model for m in models[:2]])
    forget(rows)
    lang = np.array(held["lang"].to_pylist())
    y, x, n = (held[c].to_numpy().astype(np.float64) for c in ("label", "logit", "n"))
    model = models[-1].model
    model.cut = threshold(x, y, n)
    for name in sorted(set(lang.tolist())):
        own = lang == name
        if (n * y)[own].sum() >= 20 and (n * (1 - y))[own].sum() >= 20:
            model.cuts[name] = threshold(x[own], y[own], n[own])
    return model


def best_language(languages: language.LanguageModel, logs: np.ndarray) -> str:
    return languages.languages[int(logs.argmax())] if len(logs) else ""


def scored(docs: DataFrame, model: ToxicityModel | None, languages: language.LanguageModel) -> DataFrame:
    """doc_id, score and inferred language of each document."""
    width = len(OFFSETS) * FILTERS

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model is not None:
            known = WordTable(lambda words: np.column_stack([model.rows(buckets_of(words)), languages.word_rows(words)]).astype(np.float32))
        for batch, texts in batches_of(batches):
            lang, values = [""] * len(texts), np.zeros(len(texts))
            if model is not None:
                known.begin()
                words, counts = words_of(texts, WORD, lower=True)
                ids = known.ids(words) if words else np.zeros(0, np.int64)
                table_ = known.values[: len(known.index)] if words else np.zeros((0, width + len(languages.languages) + 1), np.float32)
                logit = model.score(pooled_of(model, ids, table_, counts))
                sums = group_sum(table_[ids, width:-1], counts)
                lang = [best_language(languages, s) if n else "" for s, n in zip(sums, counts, strict=True)]
                values = sigmoid(logit - np.array([model.cuts.get(x, model.cut) for x in lang]) + CUT_LOGIT)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values), pa.array(lang, pa.string())], names=["doc_id", "score", "lang_inferred"])

    return docs.select("doc_id", "text").mapInArrow(score, docs.select("doc_id", F.lit(0.0).alias("score"), F.lit("").alias("lang_inferred")).schema)


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from those whose crc32(doc_id) mod 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    keep = id_crc() % 3 != 1
    languages = language.fit(docs, keep, per_language=None)
    model = fit(docs, table(spark, sf_dir, "labels"), keep, languages)
    held = F.coalesce(id_crc() % 3 == 1, F.lit(False)).alias("held_out")
    return scored(docs, model, languages).select("doc_id", held, "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "lang_inferred")
