"""Small frames and brute-force versions for the tests of this folder."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, key string"
CLASHES = (None, None)


def frame(spark, rows):
    """(doc_id, text[, lang]) rows as documents with extra columns whose names operators use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1]) if r[1] is not None else None, 0.5, "x") for r in rows]
    return spark.createDataFrame(full, DOC)


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def shingles(text, n=5):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def join_brute(rows, n=5):
    """doc_id -> (n_shingles of its rows, component)."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations(sets, 2):
        if i is not None and j is not None and a and b and 5 * len(a & b) >= 4 * len(a | b):
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    return {(i, len(s), find(i) if i is not None else None) for i, s in sets}


SEP = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def contamination_brute(docs, items):
    windows = {}
    for item, text in items:
        w = SEP.findall(low(text))
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(k) for k in windows}
    out = []
    for doc, text in docs:
        w, hit, found = SEP.findall(low(text)), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    found |= owners
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out
