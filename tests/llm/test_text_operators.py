"""Language, quality, toxicity: held-out accuracy on the data, and the corner cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from helpers import frame, prose
from pyspark.sql import functions as F

from rowtide.llm import language, quality, toxicity
from rowtide.llm.common import id_crc, mix, table
from rowtide.llm.learn import threshold

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "12 34 !!"), (4, "word " * 30_000), (5, "the same"), (5, "the same"), (None, "no id here")]


@pytest.fixture(scope="module")
def languages(spark):
    return language.fit(table(spark, SF, "documents"), id_crc() % 3 != 1)


def test_language_held_out(spark, languages):
    docs = table(spark, SF, "documents").where(id_crc() % 3 == 1)
    got = language.identify(docs, languages).join(docs.select("doc_id", "lang"), "doc_id")
    right, n = got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 300 and right > 0.98


def test_language_mixture_proportions(spark, languages):
    docs = table(spark, SF, "documents").where("lang in ('en', 'de') and length(text) between 800 and 3000").limit(40).collect()
    en, de = ([r["text"] for r in docs if r["lang"] == x][0].split() for x in ("en", "de"))
    mixed = frame(spark, [(1, " ".join(en[:90] + de[:30]))])
    row = language.identify(mixed, languages).first()
    assert row["lang_pred"] == "en" and set(row["languages"]) == {"en", "de"}
    assert row["score"] == pytest.approx(0.75, abs=0.2) and sum(row["proportions"]) == pytest.approx(1)


def test_language_odd_rows(spark, languages):
    got = language.identify(frame(spark, ODD), languages).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(ODD)
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["languages"] == [] for i in (1, 2, 3))
    assert by[4]["lang_pred"] != "und" and by[None]["lang_pred"] != "und"
    assert len({str(r) for r in got if r["doc_id"] == 5}) == 1
    assert language.identify(frame(spark, []), languages).count() == 0


def test_language_without_labels(spark):
    model = language.fit(frame(spark, [(1, "text", None)]), F.lit(True))
    assert language.identify(frame(spark, ODD), model).where("lang_pred <> 'und'").count() == 0


def test_mixture_of_equal_evidence_is_one_language():
    logs = np.tile([[-1.0, -1.0]], (20, 1))
    assert language.infer(logs, np.array([20])).tolist() == [[1.0, 0.0]]


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(docs, labels, id_crc() % 4 != 2)
    held = quality.scored(docs.where(id_crc() % 4 == 2), model).join(labels, "doc_id")
    ok = held.select(F.avg(((F.col("quality_score") >= 0.7) == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert ok > 0.95
    odd = quality.scored(frame(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["quality_score"] <= 1 for r in odd) and odd[0]["score"] == 0.5
    assert quality.scored(frame(spark, []), model).count() == 0


def test_quality_finds_one_bad_passage_by_attention(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(docs, labels, F.lit(True))
    good = docs.join(labels.where("quality = 1"), "doc_id").where("length(text) > 3000").first()["text"].split()[:320]
    bad = [f"{w}{'#$%&'[i % 4] * 3}" for i, w in enumerate(good[:64])]
    row = quality.scored(frame(spark, [(1, " ".join(good[:128] + bad + good[192:]))]), model).first()
    assert row["quality_passage"] == 2


def test_quality_gradients():
    rng = np.random.default_rng(1)
    passages = np.array([2, 1, 3, 2] * 10)
    x = rng.normal(size=(passages.sum(), quality.WIDTH))
    labels = np.tile([1.0, 0.0, 1.0, 0.0], 10)
    x[np.cumsum(passages) - 1, 0] += 4 * labels
    model = quality.train(x, passages, labels)
    assert ((model.logits(x, passages) > 0) == (labels == 1)).mean() > 0.95


def test_no_labels_score_one_half(spark):
    docs = frame(spark, ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, none, F.lit(True)) is None
    assert {r["quality_score"] for r in quality.scored(docs, None).collect()} == {0.5}
    assert toxicity.fit(docs, none, F.lit(True), language.fit(docs, F.lit(True))) is None
    assert {r["score"] for r in toxicity.scored(docs, None, language.fit(docs, F.lit(True))).collect()} == {0.0}


def test_toxicity_held_out(spark, languages):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels, id_crc() % 3 != 1, languages)
    held = toxicity.scored(docs.where(id_crc() % 3 == 1), model, languages).join(labels, "doc_id")
    hits = {(r["toxic"], r["p"]): r["count"] for r in held.groupBy("toxic", (F.col("score") >= 0.7).alias("p")).count().collect()}
    assert hits.get((1, True), 0) >= 0.75 * (hits.get((1, True), 0) + hits.get((1, False), 0))
    assert hits.get((0, True), 0) <= 0.06 * hits[(0, False)]
    odd = toxicity.scored(frame(spark, ODD), model, languages).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.scored(frame(spark, []), model, languages).count() == 0


def test_toxicity_learns_from_every_labelled_row(spark, languages):
    """A word of which only rows far back in the order of hashes speak, behind 1600 others of either label."""
    order = [r[0] for r in spark.range(3600).orderBy(F.xxhash64("id"), "id").collect()]
    toxic = dict.fromkeys(order[:1600] + order[3200:], 1) | dict.fromkeys(order[1600:3200], 0)
    words = {i: prose(i, 6) + (" qzork" if n < 1600 else " wvupplex" if n >= 3200 else "") for n, i in enumerate(order)}
    docs = frame(spark, list(words.items()))
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True), languages)
    asked = [(1, prose(5000, 6) + " wvupplex"), (2, prose(5001, 6) + " qzork"), (3, prose(5002, 6))]
    got = {r["doc_id"]: r["score"] >= 0.7 for r in toxicity.scored(frame(spark, asked), model, languages).collect()}
    assert got == {1: True, 2: True, 3: False}


def test_toxicity_does_not_depend_on_the_layout(spark, languages):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    models = [toxicity.fit(docs.repartition(n), labels, F.lit(True), languages) for n in (1, 5)]
    assert models[0].cut == models[1].cut and models[0].cuts == models[1].cuts
    assert all((models[0].params[k] == models[1].params[k]).all() for k in models[0].params)


def test_languages_count_every_row_without_a_bound(spark):
    docs = frame(spark, [(i, "aba aba" if i % 2 else "xyx", "en") for i in range(60)])
    every = language.fit(docs, F.lit(True), per_language=None)
    a, x = (np.exp(every.logs[language.trigrams([w])[0], 0]) for w in ("aba", "xyx"))
    assert a.sum() / x.sum() == pytest.approx(2 * 30.2 / 30.2, rel=0.02)


def test_threshold_takes_the_middle_of_the_gap():
    logits, labels = np.array([3.0, 2.0, -1.0, -2.0]), np.array([1.0, 1.0, 0.0, 0.0])
    assert threshold(logits, labels, np.ones(4)) == pytest.approx(0.5)


def numeric(loss, value, at, eps=1e-5):
    """The slope of ``loss`` along one number of an array."""
    kept = value[at]
    value[at] = kept + eps
    high = loss()
    value[at] = kept - eps
    low = loss()
    value[at] = kept
    return (high - low) / (2 * eps)


def entropy(logits, labels, weight):
    return float((weight * (np.logaddexp(0, logits) - labels * logits)).mean())


def test_gradients_of_gated_attention():
    rng = np.random.default_rng(2)
    passages = np.array([3, 1, 4, 2])
    x, labels, weight = rng.normal(size=(10, quality.WIDTH)), np.array([1.0, 0, 0, 1]), np.array([0.5, 1, 2, 1])
    h = quality.HIDDEN
    params = {"W": rng.normal(0, 0.3, (quality.WIDTH, h)), "b": rng.normal(0, 0.1, h), "V": rng.normal(0, 0.4, (h, h)), "U": rng.normal(0, 0.4, (h, h)),
              "w": rng.normal(0, 0.5, h), "u": rng.normal(0, 0.5, h), "c": rng.normal(size=1)}
    model = quality.QualityModel(params, np.zeros(quality.WIDTH), np.ones(quality.WIDTH))
    loss = lambda: entropy(model.forward(x, passages)["logit"], labels, weight)
    for name, grad in quality.gradients(model, x, passages, labels, weight).items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in params[name].shape)
            assert grad[at] == pytest.approx(numeric(loss, params[name], at), rel=1e-4, abs=1e-8)


def test_word_buckets_read_each_word_once(monkeypatch):
    """All beginnings and endings come from one pass over the characters, with the buckets of each part on its own."""

    def one(part, kind):
        h = sum((ord(c) + 7) * 0x100000001B3 ** (n + 1) for n, c in enumerate(part))
        h += (kind == toxicity.PARTS - 1) * 0x9E3779B97F4A7C15 + (kind == 0) * 0x7F4A7C15
        return 1 + int(mix(np.array([h % 2**64], np.uint64))[0]) % (toxicity.BUCKETS - 1) if part else 0

    words = ["a", "ab", "abc", "abcd", "abcde", "abcdef", "straße", "語語語語語語", "\U0001F600x" * 20]
    want = [[one(w, 0), *(one(w[:n] if len(w) > n else "", 1) for n in toxicity.STARTS), one(w[-toxicity.END :] if len(w) > toxicity.END else "", toxicity.PARTS - 1)] for w in words]
    calls, plain = [], toxicity.code_points
    monkeypatch.setattr(toxicity, "code_points", lambda own: calls.append(own) or plain(own))
    assert toxicity.buckets_of(words).tolist() == want
    assert len(calls) == 1


def test_gradients_of_the_convolution():
    """Of the dense parameters and of embeddings, around maxima that do not tie."""
    rng = np.random.default_rng(3)
    t = toxicity
    params = {"E": rng.normal(0, 0.5, (t.BUCKETS, t.DIMS)), "C": rng.normal(0, 0.3, (len(t.OFFSETS), t.DIMS, t.FILTERS)), "b": rng.normal(0.5, 0.1, len(t.WIDTHS) * t.FILTERS),
              "u": rng.normal(0, 0.5, len(t.WIDTHS) * t.FILTERS), "c": np.array([-0.3])}
    params["E"][0] = 0
    model = t.ToxicityModel(params)
    texts = [rng.integers(1, t.BUCKETS, (n, t.PARTS)) for n in (7, 1, 12)]
    labels, weight = np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])

    def loss():
        logits = []
        for own in texts:
            words = np.concatenate([own, np.zeros((2 * max(t.WIDTHS), t.PARTS), np.int64)])
            sums = sum(params["E"][words[:, p]] for p in range(t.PARTS))
            pooled = []
            for w in t.WIDTHS:
                values = [sum(sums[s + o] @ params["C"][t.OFFSETS.index((w, o))] for o in range(w)) for s in range(len(own) + 1)]
                pooled.append(np.max(values, axis=0))
            logits.append(np.maximum(np.concatenate(pooled) + params["b"], 0) @ params["u"] + params["c"][0])
        return entropy(np.array(logits), labels, weight)

    grads, touched = t.gradients(model, texts, labels, weight)
    for name, grad in grads.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in params[name].shape)
            assert grad[at] == pytest.approx(numeric(loss, params[name], at), rel=1e-3, abs=1e-6)
    slopes = np.zeros_like(params["E"])
    for flat, step in touched:
        for p in range(t.PARTS):
            np.add.at(slopes, flat[:, p], step)
    for bucket in texts[0][2:4].ravel():
        for d in (0, 3):
            assert slopes[bucket, d] == pytest.approx(numeric(loss, params["E"], (bucket, d)), rel=1e-3, abs=1e-6)


def em(logs, languages):
    """Proportions and likelihood of one document, word by word."""
    share = {l: 1 / len(languages) for l in languages}
    for _ in range(language.ROUNDS):
        total = dict.fromkeys(languages, 0.0)
        for row in logs:
            joint = {l: share[l] * math.exp(row[l]) for l in languages}
            for l in languages:
                total[l] += joint[l] / sum(joint.values())
        share = {l: v / len(logs) for l, v in total.items()}
    return share, sum(math.log(sum(share[l] * math.exp(row[l]) for l in languages)) for row in logs)


def test_mixtures_against_em_word_by_word():
    """Proportions, likelihoods and the selected languages of single documents and of all together."""
    rng = np.random.default_rng(6)
    counts, width = np.array([40, 3, 25, 60]), 4
    logs = rng.normal(-3, 0.3, (counts.sum(), width))
    owner = np.repeat(np.arange(4), counts)
    for doc, strong in enumerate(((0,), (1, 2), (3, 1), (0, 2, 3))):
        at = np.flatnonzero(owner == doc)
        logs[at, rng.choice(strong, len(at))] += 2.5
    sets = np.array([[1, 1, 1, 1], [0, 1, 1, 0], [1, 0, 0, 1], [1, 0, 1, 1]], bool)
    share, likelihood = language.proportions(logs, counts, sets)
    got = language.infer(logs, counts)
    for doc in range(4):
        own = logs[owner == doc]
        want, at_best = em(own, np.flatnonzero(sets[doc]).tolist())
        assert share[doc] == pytest.approx([want.get(l, 0) for l in range(width)], abs=1e-9) and likelihood[doc] == pytest.approx(at_best)
        # One language after another joins, the best first, while the penalised likelihood grows.
        chosen = [int(own.sum(axis=0).argmax())]
        now, best = em(own, chosen)
        while len(chosen) < width:
            tries = [(em(own, sorted([*chosen, l])), l) for l in range(width) if l not in chosen]
            (mixed, value), l = max(tries, key=lambda t: t[0][1])
            if value - best - 2.0 * math.log(len(own) + 1.0) <= 0:
                break
            chosen, now, best = [*chosen, l], mixed, value
        assert got[doc] == pytest.approx([now.get(l, 0) for l in range(width)], abs=1e-4)
