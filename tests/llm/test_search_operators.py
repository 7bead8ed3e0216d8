"""Collocations, vector search and lexical search against brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import SEP, low
from pyarrow import dataset
from pyspark.sql import functions as F

from rowtide.llm import collocations, common, lexical, segment_search, treap

TEXTS = "doc_id long, text string, lang string, f string, h string, word string, score double"


def texts(spark, rows):
    """(doc_id, text, lang) rows with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", None, "y", 0.5) for r in rows], TEXTS)


def pieces(text):
    text = low(text)
    for c in ".,;:!?\n\x0b\x0c\r":
        text = text.replace(c, "\n")
    return [p.replace("\t", " ").split(" ") for p in text.split("\n")]


def collocations_brute(rows, least, top):
    f, out = {}, set()
    for _, text, lang in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for piece in pieces(text):
            w = [x for x in piece if x]
            own.update(tuple(w[i : i + k]) for i in range(len(w)) for k in range(1, 6) if i + k <= len(w))
    for lang, own in f.items():
        n = sum(v for k, v in own.items() if len(k) == 1)
        many = {k: v for k, v in own.items() if len(k) > 1 and v >= least}
        found = []
        for p, a in many.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: E731, B023
            if any(len(q) > len(p) and v >= a and inside(q) for q, v in many.items()):
                continue
            score, _, left, right = min((1000 * a * n // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def spoken(seed, docs):
    """Skewed words, a passage of six that repeats, one very frequent pair, odd white space."""
    rng, rows = random.Random(seed), []
    for i in range(docs):
        words = [f"w{min(int(rng.expovariate(0.4)), 30)}" for _ in range(rng.randrange(60))]
        if i % 3 == 0:
            words += ["The", "quick", "Brown", "fox", "jumps", "Über"]
        if i % 2:
            words += ["hot", "hot"] * 6
        text = "".join(w + rng.choice([" ", "  ", "\t", " ", ", ", ".\n", "\x0b"]) for w in words)
        rows.append((i % 40, text, rng.choice(["en", "en", "en", "fr", None])))
    return [*rows, (None, None, "en"), (1, "", None), (2, " .,. ", "de"), (3, "one", "de"), rows[0], rows[0]]


@pytest.mark.parametrize("budget", [10**6, 40])
def test_collocations(spark, budget):
    rows = spoken(1, 150)
    got = collocations.collocations(texts(spark, rows), 8, 12, budget)
    want = collocations_brute(rows, 8, 12)
    assert {tuple(r) for r in got.collect()} == want
    assert got.count() == len(want) > 20


def test_blocks_lose_no_phrase(monkeypatch):
    """However small the blocks and slices are, every suffix begins in one block and is whole there."""
    monkeypatch.setattr(collocations, "BLOCK_TOKENS", 50)
    monkeypatch.setattr(collocations, "SLICE", 30)
    rows = spoken(2, 40)
    batch = pa.RecordBatch.from_pylist([{"lang": lang or "und", "text": text} for _, text, lang in rows])
    got, many = Counter(), 0
    for block in collocations.blocks(iter([batch])):
        many += 1
        for i in range(block.limit):
            for k in range(1, 6):
                ids = block.ids[i : i + k]
                if len(ids) == k and 0 not in ids:
                    got[block.langs[block.lang[i]], " ".join(block.words[x].decode() for x in ids)] += 1
    want = Counter()
    for _, text, lang in rows:
        for piece in pieces(text):
            w = [x for x in piece if x]
            want.update((lang or "und", " ".join(w[i : i + k])) for i in range(len(w)) for k in range(1, 6) if i + k <= len(w))
    assert got == want and many > 20


def test_colliding_words_get_another_seed(spark, monkeypatch):
    real, seeds = collocations.word_counts, []

    def clashing(docs, seed):
        seeds.append(seed)
        return real(docs, seed).withColumn("clash", F.lit(seed == 0) | F.col("clash"))

    monkeypatch.setattr(collocations, "word_counts", clashing)
    rows = [(1, "a b c. " * 9, "en"), (2, "d e. " * 5, "en")]
    got = collocations.collocations(texts(spark, rows), 5, 10)
    assert {tuple(r) for r in got.collect()} == collocations_brute(rows, 5, 10) and seeds == [0, 2]


def test_collocations_of_little(spark):
    for rows in ([], [(1, None, None)], [(1, "a b", "en")]):
        assert collocations.collocations(texts(spark, rows)).count() == 0
    rows = [(1, "x y " * 3000, "en")]
    got = collocations.collocations(texts(spark, rows), 100, 2000)
    assert {tuple(r) for r in got.collect()} == collocations_brute(rows, 100, 2000)


def test_exact_products(spark):
    """Products beyond 64 bits."""
    a, n, left, right = 9 * 10**12, 9 * 10**17, 9 * 10**12 + 1, 10**13
    df = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    got = df.select(collocations.ratio(df.a, df.n, df.l, df.r).alias("x")).first()["x"]
    assert got == 1000 * a * n // (left * right)


def search_brute(docs, items, k=10):
    counted = [(i, Counter(SEP.findall(low(t)))) for i, t in docs]
    n, total = sum(bool(c) for _, c in counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for i, c in counted:
            m = 10 + 90 * c.total() * n // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(SEP.findall(low(text))) if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out.update((item, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1))
    return out


def treap_cells(seed, rows, columns, n):
    rng = np.random.default_rng(seed)
    cells = np.unique(np.stack([(rng.random(n) ** 3 * rows).astype(np.int64), rng.integers(0, columns, n)]), axis=1)
    return cells[0], cells[1], rng.integers(1, 10**6, cells.shape[1])


@pytest.mark.parametrize(("rows", "columns", "n"), [(1, 1, 1), (300, 20, 900), (5, 1000, 2000), (64, 64, 3000)])
def test_treap_descends_to_the_best_columns(rows, columns, n):
    r, c, v = treap_cells(1, rows, columns, n)
    tree = treap.Treap(**treap.build(r, c, v))
    for asked in ([0], [0, rows - 1], list(range(min(rows, 9)))):
        asked = np.array(sorted(set(asked)))
        weights = np.arange(1, len(asked) + 1)
        want = np.zeros(columns, np.int64)
        for w, a in zip(weights, asked, strict=True):
            np.add.at(want, c[r == a], w * v[r == a])
        floor = int(np.sort(want)[-min(columns, 5)]) or 1
        for least in (1, floor):
            got = {}
            for at, sums in tree.heaviest(asked, weights, least, width=40):
                got |= dict(zip(at.tolist(), sums.tolist(), strict=True))
            assert got == {i: s for i, s in enumerate(want.tolist()) if s >= least}


def lexical_rows():
    docs = [(i % 300, t) for i, (_, t, _) in enumerate(spoken(3, 320))]
    items = [(i, t) for i, (_, t, _) in enumerate(spoken(4, 25))]
    return docs, [*items, (7, "quick quick QUICK fox"), (7, "w1"), (None, "über hot"), (90, ""), (91, None), (92, "nowhere"), (7, "w1")]


@pytest.mark.parametrize("tokens", [10**6, 300])
def test_lexical_search(spark, monkeypatch, tokens):
    monkeypatch.setattr(lexical, "SHARD_TOKENS", tokens)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 10**6 if tokens > 300 else 20)
    docs, items = lexical_rows()
    asked = spark.createDataFrame([(*r, "z", 1) for r in items], "item_id long, text string, terms string, block int")
    got = lexical.ranked(texts(spark, [(*r, None) for r in docs]), asked)
    assert Counter(tuple(r) for r in got.collect()) == search_brute(docs, items)


def test_lexical_search_in_little(spark):
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    none = one.where("item_id > 1")
    docs = texts(spark, [(1, None, None), (None, "", None), (2, " ;; ", "en")])
    assert lexical.ranked(docs, one).count() == lexical.ranked(docs.limit(0), one).count() == lexical.ranked(docs, none).count() == 0
    docs = texts(spark, [(1, "A-b " * 5, None), (None, "a b", None), (2, "a b", "en"), (1, "c", "en")])
    got = lexical.ranked(docs, one)
    assert Counter(tuple(r) for r in got.collect()) == search_brute([(r[0], r[1]) for r in docs.collect()], [(1, "a b")])


def test_shards_leave_the_worker_compressed():
    """A cell takes a few bytes of a row, not four at every level of the grid."""
    shard, rng = lexical.Shard(), random.Random(6)
    for i in range(400):
        shard.add(i, " ".join(f"w{min(int(rng.expovariate(0.002)), 4000)}" for _ in range(300)).encode())
    row = shard.row(400, 120_000)
    size = sum(len(b) for v in row.values() if not isinstance(v, int) for b in ([v] if isinstance(v, bytes) else v))
    assert len(shard.cells[0]) > 50_000 and size < 6 * len(shard.cells[0])


def test_shards_are_read_a_few_at_a_time(spark, monkeypatch):
    """However many shards a task makes, its file has groups of bounded size; texts pass in bounded batches."""
    monkeypatch.setattr(lexical, "SHARD_TOKENS", 300)
    monkeypatch.setattr(lexical, "GROUP_BYTES", 4096)
    spark.conf.unset(common.ARROW_BYTES)
    docs, items = lexical_rows()
    frame = texts(spark, [(*r, None) for r in docs]).coalesce(1)
    shards = lexical.index(frame, *lexical.sizes(frame))
    assert spark.conf.get(common.ARROW_BYTES) == common.ARROW_MOST
    (file,) = (x for x in dataset.dataset(shards.stored_at).get_fragments())
    assert len(file.row_groups) > 5 and max(g.num_rows for g in file.row_groups) <= 5 < shards.count() / 5


def nearest_brute(rows, k):
    own = [(n, i, [math.floor(64 * x) for x in v]) for n, (i, v) in enumerate(rows) if i is not None and v and None not in v and all(map(math.isfinite, v))]
    out = Counter()
    for n, q, x in own:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i, m) for m, i, y in own if m != n and len(x) == len(y))
            out.update((q, rank, i, -score) for rank, (score, i, _) in enumerate(found[:k], 1))
    return out


def vector_rows(seed, n):
    """Clusters, ties, repeated ids and rows, one hot vector, and what cannot take part."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 24))
    rows = [(i, (centres[i % 6] + 0.3 * rng.standard_normal(24)).round(2).tolist()) for i in range(n)]
    hot = centres[0].tolist()
    rows += [(1000 + i, hot) for i in range(90)] + [(i % 40, rng.integers(-1, 2, 24).astype(float).tolist()) for i in range(100)]
    rows += [rows[0], rows[20], (20, [0.0] * 24), (40, [1.0, 2.0]), (60, [0.5, 0.25]), (61, [0.5, -1.0]), (80, [3.0]), (100, [])]
    return [*rows, (120, None), (None, hot), (140, [float("nan")] * 24), (160, [float("inf"), *hot[1:]]), (180, [None, *hot[1:]])]


VECTOR = "vec_id long, embedding array<double>, row string, q string, block string, mean double"


@pytest.mark.parametrize(("size", "together"), [(2048, 512), (24, 2)])
def test_segment_search(spark, monkeypatch, size, together):
    monkeypatch.setattr(segment_search, "CANDIDATES", size)
    monkeypatch.setattr(segment_search, "QUERIES", size // 2)
    monkeypatch.setattr(segment_search, "TOGETHER", together)
    rows = vector_rows(5, 300)
    df = spark.createDataFrame([(*r, "r", "q", None, 0.1) for r in rows], VECTOR)
    got = segment_search.top_k(df, F.col("id") % 20 == 0, 7)
    assert Counter(tuple(r) for r in got.collect()) == nearest_brute(rows, 7)


def test_segment_search_of_little(spark):
    empty = spark.createDataFrame([], VECTOR)
    assert segment_search.top_k(empty, F.col("id") % 20 == 0).count() == 0
    # Scores near the end of 64 bits; longer vectors than that take no part.
    rows = [(0, [3e7, 1.0, -2e7]), (1, [4e7, 0.5, 1e7]), (2, [-4.7e7, 0.0, 0.0]), (20, [1e9, 0.0, 0.0])]
    df = spark.createDataFrame([(*r, "r", "q", None, 0.1) for r in rows], VECTOR)
    assert Counter(tuple(r) for r in segment_search.top_k(df, F.col("id") % 20 == 0).collect()) == nearest_brute(rows[:3], 20)


@pytest.mark.parametrize("dims", [1, 3, 8, 17, 64])
def test_bounds_hold_and_grow_closer(dims):
    rng = np.random.default_rng(dims)
    q, c = (rng.integers(-60, 60, (n, dims)) + rng.integers(-9, 9, (n, 1)) for n in (40, 50))
    exact, before = q @ c.T, np.inf
    for count in (1, 2, 4, 8, 16):
        now = segment_search.features(q, count) @ segment_search.features(c, count).T
        assert (now + segment_search.slack(q, c) >= exact).all()
        if dims % 16 == 0:
            assert now.mean() <= before + 1e-6
            before = now.mean()
    cut = np.sort(exact, axis=1)[:, -5]
    got, alive = segment_search.scores(q, c, cut)
    assert (alive == (exact >= cut[:, None])).all() and (got[alive] == exact[alive]).all()
