"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words; only the document is labelled.  Every
passage is encoded by a small network over its word shapes and repetitions, gated attention
weighs the encodings, and the weighted sum is scored.  So one bad passage in a long text can
decide, and the attention tells which one did.

Features are computed by Spark.  The network is trained in numpy on the driver with at most
``bound`` documents of each label, cross-fitted to place the cut at a score of 0.7.  Scoring
is one pass without a shuffle over whole texts.

Null and empty texts are one passage without words.  Ties do not arise: rows are scored one
by one.  Extra columns are ignored.  With an empty table the result is empty; without labels
of both kinds every score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import WordTable, batches_of, group_sum, id_crc, in_batches, labelled_ids, plain, table, without, words_of
from rowtide.llm.learn import CUT, CUT_LOGIT, Adam, natural_weights, out_of_fold, sigmoid, threshold

PASSAGE = 64
HIDDEN = 16
SHAPES = 16
WIDTH = 9 + SHAPES + 4


def word_rows(words: list[str]) -> np.ndarray:
    """Numbers of a word: length, letters, capitals, digits, punctuation, symbols, ...; its shape's bucket."""
    out = np.zeros((len(words), 9 + SHAPES), np.float32)
    for n, w in enumerate(words):
        alpha = sum(map(str.isalpha, w))
        upper = sum(map(str.isupper, w))
        digit = sum(map(str.isdigit, w))
        punct = sum(c in ".,;:!?'\"()-" for c in w)
        kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c if ord(c) < 128 else "~" for c in w)
        shape = re.sub(r"(.)\1+", r"\1", kinds)
        bucket = sum((i + 1) * ord(c) for i, c in enumerate(shape[:12])) % SHAPES
        row = out[n]
        row[:9] = (min(len(w), 40), alpha, upper, digit, punct, len(w) - alpha - digit - punct, alpha > 2 and upper == alpha, alpha == 0, len(w) > 24)
        row[9 + bucket] = 1
    return out


def bags(texts: list[str | None], known: WordTable) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages one after the other, and the number of each text's passages."""
    known.begin()
    words, counts = words_of(texts, None)
    ids = known.ids(words) if words else np.zeros(0, np.int64)
    passages = np.maximum(1, -(-counts // PASSAGE))
    sizes = np.full(int(passages.sum()), PASSAGE, np.int64)
    ends = np.cumsum(passages)
    sizes[ends - 1] = counts - (passages - 1) * PASSAGE
    n = np.maximum(sizes, 1)[:, None]
    out = np.zeros((len(sizes), WIDTH))
    if words:
        out[:, : 9 + SHAPES] = group_sum(known.values[ids], sizes) / n
        owner = np.repeat(np.arange(len(sizes)), sizes)
        for place, lag in enumerate((1, 2)):
            same = np.zeros(len(ids))
            same[lag:] = (ids[lag:] == ids[:-lag]) & (owner[lag:] == owner[:-lag])
            out[:, 9 + SHAPES + place] = group_sum(same, sizes) / n[:, 0]
        pairs = np.unique(owner * (len(known.index) + 1) + ids) // (len(known.index) + 1)
        out[:, -2] = np.bincount(pairs, minlength=len(sizes)) / n[:, 0]
    out[:, -1] = np.log1p(sizes)
    return out, passages


@dataclass
class QualityModel:
    """Trained parameters, the scale of the features, and what a logit is lowered by."""

    params: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    shift: float = 0.0

    def forward(self, x: np.ndarray, passages: np.ndarray) -> dict[str, np.ndarray]:
        p = self.params
        x = np.clip((x - self.mean) / self.scale, -8, 8)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        starts = np.cumsum(passages) - passages
        owner = np.repeat(np.arange(len(passages)), passages)
        a = np.exp(e - np.maximum.reduceat(e, starts)[owner])
        a /= np.add.reduceat(a, starts)[owner]
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"x": x, "h": h, "t": t, "s": s, "a": a, "z": z, "owner": owner, "starts": starts, "logit": z @ p["u"] + p["c"][0]}

    def logits(self, x: np.ndarray, passages: np.ndarray) -> np.ndarray:
        return self.forward(x, passages)["logit"] - self.shift


def gradients(model: QualityModel, x: np.ndarray, passages: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Of the weighted mean cross entropy, by every parameter."""
    f, params = model.forward(x, passages), model.params
    d = (sigmoid(f["logit"]) - labels) * weight / len(labels)
    dz = d[:, None] * params["u"]
    own = dz[f["owner"]]
    da = (own * f["h"]).sum(axis=1)
    de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["starts"])[f["owner"]])
    gate = de[:, None] * params["w"]
    dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
    dh = (f["a"][:, None] * own + dt @ params["V"].T + ds @ params["U"].T) * (1 - f["h"] ** 2)
    return {
        "W": f["x"].T @ dh, "b": dh.sum(axis=0), "V": f["h"].T @ dt, "U": f["h"].T @ ds,
        "w": de @ (f["t"] * f["s"]), "u": d @ f["z"], "c": np.array([d.sum()]),
    }


def train(x: np.ndarray, passages: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 64, seed: int = 7) -> QualityModel:
    """Fit by Adam; both labels weigh the same."""
    rng = np.random.default_rng(seed)
    params = {
        "W": rng.normal(0, 0.2, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.2, (HIDDEN, HIDDEN)), "U": rng.normal(0, 0.2, (HIDDEN, HIDDEN)),
        "w": rng.normal(0, 0.2, HIDDEN), "u": rng.normal(0, 0.2, HIDDEN), "c": np.zeros(1),
    }
    model = QualityModel(params, x.mean(axis=0), np.maximum(x.std(axis=0), 0.02))
    adam = Adam(params, 0.01)
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    starts = np.cumsum(passages) - passages
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(labels)), max(1, len(labels) // batch)):
            n = passages[at]
            rows = np.arange(n.sum()) + np.repeat(starts[at] - (np.cumsum(n) - n), n)
            grads = gradients(model, x[rows], n, labels[at], weight[at])
            adam.step({k: g + 1e-4 * params[k] for k, g in grads.items()})
    return model


def fit(docs: DataFrame, labels: DataFrame, keep: Column, bound: int = 3000, label: str = "quality") -> QualityModel | None:
    """A model from the labelled rows that ``keep`` admits; None without rows of both labels."""
    chosen = labelled_ids(labels, label, keep, bound)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTable(word_rows)
        for batch, texts in batches_of(batches):
            x, passages = bags(texts, known)
            cuts = np.cumsum(passages)[:-1]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "label": batch.column("label"), "x": [p.astype(np.float32).tobytes() for p in np.split(x, cuts)]}
            )

    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # At most 2 x bound bags come to the driver.
    rows = in_batches(sample, features, "doc_id long, label int, x binary").orderBy(F.xxhash64("doc_id"), "x").collect()
    known_labels = np.array([r["label"] for r in rows], np.float64)
    if len(set(known_labels.tolist())) < 2:
        return None
    each = [np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH).astype(np.float64) for r in rows]

    def pick(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([each[i] for i in at]), np.array([len(each[i]) for i in at])

    def fit_on(at: np.ndarray) -> QualityModel:
        return train(*pick(at), known_labels[at])

    # Two counts.
    totals = {r["label"]: r["n"] for r in labels.where(keep).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n")).collect()}
    logits = out_of_fold(len(rows), 3, fit_on, lambda m, at: m.logits(*pick(at)))
    model = fit_on(np.arange(len(rows)))
    model.shift = threshold(logits, known_labels, natural_weights(known_labels, totals)) - CUT_LOGIT
    return model


def scored(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """``docs`` plus quality_score and quality_passage (the passage that attention weighs most).

    Columns of ``docs`` that have these names are replaced.
    """
    made = ["quality_score", "quality_passage"]
    names = (docs := without(docs, *made)).columns
    docs = plain(docs, "text")
    schema = docs.withColumns({"quality_score": F.lit(0.0), "quality_passage": F.lit(0)}).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordTable(word_rows)
        for batch, texts in batches_of(batches):
            if model is None:
                values, most = np.full(len(texts), 0.5), np.zeros(len(texts), np.int32)
            else:
                f = model.forward(*bags(texts, known))
                values = sigmoid(f["logit"] - model.shift)
                most = np.array([a.argmax() for a in np.split(f["a"], f["starts"][1:])], np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values), pa.array(most)], names=[*batch.schema.names, "quality_score", "quality_passage"])

    return in_batches(docs, score, schema).toDF(*names, *made)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from those whose crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), id_crc() % 4 != 2)
    held = F.coalesce(id_crc() % 4 == 2, F.lit(False)).alias("held_out")
    return scored(docs, model).select(
        "doc_id", held, F.col("quality_score").alias("score"), (F.col("quality_score") >= CUT).cast("int").alias("predicted"), F.col("quality_passage").alias("passage")
    )
