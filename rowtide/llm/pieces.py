"""Sampled SentencePiece segmentations, and lossless decoding.

All ways to cut a text into pieces of a vocabulary form a lattice.  Forward filtering sums the
weights of all paths to each position; backward sampling walks from the end and draws each
piece in proportion, so a segmentation comes out with exactly its share of the total weight.
A piece of rank r weighs (r + 100) ** -alpha; characters without a piece become their UTF-8
bytes.  Draws are hashes of (seed, row key, word, step): a row gets the same pieces wherever
and whenever it is encoded.

No piece runs over the start of a word, so the lattice is cut there without changing any
probability.  A worker remembers the lattices of words, draws the pieces of all words of many
texts at once, and holds text of bounded size.  One pass, no shuffle.

Spaces are kept as they are and nothing is normalised: decoding gives the text back, byte by
byte.  Null is encoded as no pieces and decodes to the empty text.  A null key counts as 0.
Repeated rows get equal pieces; extra columns stay; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import Index, batches_of, busiest, code_points, group_sum, in_batches, mix, plain, ranges, table, without

SPACE = "▁"
#: Distinct words a worker remembers, at about a kilobyte each.
WORDS = 60_000
LETTER = re.compile(r"[^\W\d_¹²³¼½¾]")
#: Words by letters or not, where no piece mixes them; else up to the next space.
FINE = re.compile(r" *[^\W\d_¹²³¼½¾]+| *(?:[^ \n\w]|[\d_¹²³¼½¾])+| +|\n")
COARSE = re.compile(r" *[^ \n]+| +|\n")
WHOLE = re.compile(r"(?s).+")


class Pieces:
    """The vocabulary of a model file, and the lattices of words met so far."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.byte = [0] * 256
        surface: list[bytes] = []
        spelt: list[tuple[str, int, float]] = []
        body, longest = [], 1
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[1:-1], 16)] = i
                surface.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                surface.append(b"")
            else:
                surface.append(piece.replace(SPACE, " ").encode())
                rank = min(-model.get_score(i), self.size)
                spelt.append((piece, i, (max(rank, 0.0) + 100.0) ** -alpha))
                body.append(piece.lstrip(SPACE))
                longest = max(longest, len(piece))
        self.longest = longest
        inner = any(SPACE in p or "\n" in p[1:] or "\n" in p[:-1] for p in body)
        mixed = any(bool(LETTER.match(a)) != bool(LETTER.match(b)) for p in body for a, b in zip(p, p[1:], strict=False))
        self.pattern = WHOLE if inner else COARSE if mixed else FINE
        lengths = np.array(list(map(len, surface)), np.int64)
        self.surface, self.surface_at, self.surface_length = np.frombuffer(b"".join(surface), np.uint8), np.cumsum(lengths) - lengths, lengths
        self._spell(spelt)
        self._reset()

    def _spell(self, spelt: list[tuple[str, int, float]]) -> None:
        """A trie of the pieces in arrays: children by (node, character), and each node's piece and weight."""
        self.chars = np.unique(np.array([ord(c) for c in {c for piece, _, _ in spelt for c in piece}], np.uint32))
        number = {chr(c): n for n, c in enumerate(self.chars.tolist())}
        children: dict[int, int] = {}
        ends = {}
        for piece, i, weight in spelt:
            node = 0
            for c in piece:
                node = children.setdefault(node * len(number) + number[c], len(children) + 1)
            ends[node] = i, weight
        keys, nodes = np.array(list(children), np.int64), np.array(list(children.values()), np.int64)
        order = np.argsort(keys)
        # One key more than any that is asked for, so that a search stays inside.
        self.step, self.child = np.append(keys[order], np.iinfo(np.int64).max), np.append(nodes[order], 0)
        self.piece, self.weight = np.full(len(children) + 1, -1, np.int32), np.zeros(len(children) + 1)
        for node, (i, weight) in ends.items():
            self.piece[node], self.weight[node] = i, weight

    def _reset(self) -> None:
        self.index = Index()
        self.length, self.state = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.edge, self.share, self.back, self.code = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.byte_runs: dict[bytes, int] = {}
        self.hits = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep the words met most often."""
        keep = busiest(self.hits, WORDS // 2)
        words = list(self.index)
        self.index = Index()
        for n in keep.tolist():
            self.index[words[n]]
        self.index.fresh = []
        states = ranges(self.state[keep], self.length[keep])
        starts, counts = self.edge[states], np.diff(self.edge, append=len(self.share))[states]
        edges = ranges(starts, counts)
        self.length, self.hits = self.length[keep], np.zeros(len(keep), np.int64)
        self.state, self.edge = np.cumsum(self.length) - self.length, np.cumsum(counts) - counts
        self.share, self.back, self.code = self.share[edges], self.back[edges], self.code[edges]

    def _edges(self, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last character, id and weight of every piece that fits; sorted by last, then first.

        ``text`` are code points of words one after the other, ``ends`` each character's end of word.
        """
        shown = np.where(text == ord(" "), np.uint32(ord(SPACE)), text)
        at = np.minimum(np.searchsorted(self.chars, shown), len(self.chars) - 1)
        number = np.where((self.chars[at] == shown) & (text != ord(SPACE)), at, -1)
        first, node = np.arange(len(text)), np.zeros(len(text), np.int64)
        parts = []
        for d in range(self.longest):
            inside = first + d < ends[first]
            first, node = first[inside], node[inside]
            c = number[first + d]
            key = np.where(c >= 0, node * len(self.chars) + c, -1)
            at = np.searchsorted(self.step, key)
            known = self.step[at] == key
            first, node = first[known], self.child[at[known]]
            whole = self.piece[node] >= 0
            parts.append((first[whole], first[whole] + d, self.piece[node[whole]], self.weight[node[whole]]))
        spelt = np.zeros(len(text), bool)
        spelt[parts[0][0]] = True
        bare = np.flatnonzero(~spelt)
        kinds, kind = np.unique(text[bare], return_inverse=True)
        runs = [chr(c).encode("utf-8", "surrogatepass") for c in kinds.tolist()]
        code = np.array([self.byte[r[0]] if len(r) == 1 else self.size + self.byte_runs.setdefault(r, len(self.byte_runs)) for r in runs], np.int32)
        weight = np.array([1e-6 ** len(r) for r in runs])
        parts.append((bare, bare, code[kind] if len(bare) else code, weight[kind] if len(bare) else weight))
        first, last, code, weight = (np.concatenate(p) for p in zip(*parts, strict=True))
        order = np.lexsort((first, last))
        return first[order], last[order], code[order], weight[order]

    def _filter(self, first: np.ndarray, last: np.ndarray, weight: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Forward filtering of all words together, place by place: the share of each edge in the weight of all paths to its end."""
        begin = np.repeat(starts, lengths)
        word = np.repeat(np.arange(len(lengths)), lengths)
        # paths[i]: weight of all paths to the end of character i; at_start: to the start of a word.
        paths, at_start = np.zeros(len(begin)), np.ones(len(lengths))
        place = (last - begin[last]).astype(np.int64)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(int(lengths.max()) + 1))
        share = np.zeros(len(first))
        for a, b in zip(cuts, cuts[1:], strict=False):
            e = order[a:b]
            end = last[e]
            own = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
            while True:
                before = np.where(first[e] == begin[first[e]], at_start[word[first[e]]], paths[first[e] - 1])
                into = before * weight[e]
                total = np.add.reduceat(into, own)
                low = np.flatnonzero(total < 1e-150)
                if not len(low):
                    break
                # What the next pieces can start from is lifted together.
                for i in end[own[low]].tolist():
                    near = max(int(begin[i]), i - self.longest)
                    paths[near:i] *= 1e150
                    at_start[word[i]] *= 1e150 if near == begin[i] else 1.0
            paths[end[own]] = total
            share[e] = into / np.repeat(total, np.diff(own, append=len(e)))
        # Shares are added up over the edges of a state; its last one takes the rest.
        new = np.append(True, last[1:] != last[:-1])
        nth = np.arange(len(last)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        for k in range(1, int(nth.max(initial=0)) + 1):
            at = np.flatnonzero(nth == k)
            share[at] += share[at - 1]
        share[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)] = 2.0
        return share

    def _learn(self, fresh: list[str]) -> None:
        """Lattices of new words: for each position the edges that end there, with cumulated shares."""
        text, lengths = code_points(fresh)
        starts = np.cumsum(lengths) - lengths
        first, last, code, weight = self._edges(text, np.repeat(starts + lengths, lengths))
        share = self._filter(first, last, weight, starts, lengths)
        self.state = np.concatenate([self.state, len(self.edge) + starts])
        self.length = np.concatenate([self.length, lengths])
        self.edge = np.concatenate([self.edge, len(self.share) + np.flatnonzero(np.append(True, last[1:] != last[:-1]))])
        self.share = np.concatenate([self.share, share])
        self.back = np.concatenate([self.back, (first - np.repeat(starts, lengths)[first]).astype(np.int32)])
        self.code = np.concatenate([self.code, code.astype(np.int32)])

    def encode(self, texts: list[str], keys: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        if len(self.index) > WORDS:
            self._forget()
        words, counts = [], []
        for text in texts:
            own = self.pattern.findall(text)
            words += own
            counts.append(len(own))
        counts = np.array(counts, np.int64)
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        for start in range(0, len(self.index.fresh), 20_000):
            self._learn(self.index.fresh[start : start + 20_000])
        self.index.fresh = []
        hits = np.bincount(at, minlength=len(self.index))
        hits[: len(self.hits)] += self.hits
        self.hits = hits
        place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
        base = np.repeat(mix(keys.astype(np.int64).view(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)), counts)
        base = base + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        left, first = self.length[at], self.state[at]
        live, step = np.arange(len(words)), 0
        taken, codes, number = [], [], np.zeros(len(words), np.int64)
        while len(live):
            u = (mix(base[live] + np.uint64(step * 0x8CB92BA72F3D8DD7 % 2**64)) >> np.uint64(11)) * (0.5**53)
            edge = self.edge[first[live] + left[live] - 1]
            low = np.flatnonzero(self.share[edge] <= u)
            while len(low):
                edge[low] += 1
                low = low[self.share[edge[low]] <= u[low]]
            taken.append(live)
            codes.append(self.code[edge])
            left[live] = self.back[edge]
            number[live] += 1
            live, step = live[left[live] > 0], step + 1
        ends = np.cumsum(number)
        ids = np.zeros(int(number.sum()), np.int32)
        for n, (own, code) in enumerate(zip(taken, codes, strict=True)):
            ids[ends[own] - 1 - n] = code
        per_text = group_sum(number, counts).astype(np.int64)
        if (ids >= self.size).any():
            runs = [np.array([self.byte[b] for b in run], np.int32) for run in self.byte_runs]
            owner = np.repeat(np.arange(len(texts)), per_text)
            sizes = np.ones(len(ids), np.int64)
            long_ = np.flatnonzero(ids >= self.size)
            sizes[long_] = [len(runs[i - self.size]) for i in ids[long_]]
            starts = np.cumsum(sizes) - sizes
            wide = np.repeat(ids, sizes)
            for i in long_:
                wide[starts[i] : starts[i] + sizes[i]] = runs[ids[i] - self.size]
            per_text = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)
            ids = wide
        return ids, per_text

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes that a sequence of ids stands for."""
        return self.surface[ranges(self.surface_at[ids], self.surface_length[ids])].tobytes()


@lru_cache(maxsize=1)
def pieces_of(path: str, alpha: float) -> Pieces:
    """A worker's vocabulary and lattices, kept over its tasks."""
    return Pieces(path, alpha)


def encode(docs: DataFrame, model: str, key: str = "doc_id", alpha: float = 0.75, seed: int = 0) -> DataFrame:
    """``docs`` plus ids, n_pieces, ids_crc32 and lossless (the ids decode to the text).

    Columns of ``docs`` that have these names are replaced.
    """
    made = ["ids", "n_pieces", "ids_crc32", "lossless"]
    names = (docs := without(docs, *made)).columns
    docs = plain(docs, "text", key)
    schema = docs.withColumns(
        {"ids": F.array().cast("array<int>"), "n_pieces": F.lit(0).cast("long"), "ids_crc32": F.lit(0).cast("long"), "lossless": F.lit(True)}
    ).schema

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces_of(model, alpha)
        for batch, texts in batches_of(batches):
            texts = [t or "" for t in texts]
            keys = np.array([k or 0 for k in batch.column(key).to_pylist()], np.int64)
            ids, n = known.encode(texts, keys, seed)
            ends = np.cumsum(n)
            each = [memoryview(ids)[e - c : e] for e, c in zip(ends.tolist(), n.tolist(), strict=True)]
            lossless = [known.decode(np.asarray(i)) == t.encode("utf-8", "surrogatepass") for i, t in zip(each, texts, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists, pa.array(n), pa.array([zlib.crc32(i) for i in each], pa.int64()), pa.array(lossless, pa.bool_())],
                names=[*batch.schema.names, "ids", "n_pieces", "ids_crc32", "lossless"],
            )

    return in_batches(docs, sample, schema).toDF(*names, *made)


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` plus decoded: the text of the ids; bytes that are no text are replaced."""
    encoded = without(encoded, "decoded")
    schema = encoded.withColumn("decoded", F.lit("")).schema

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces_of(model, 1.0)
        for batch in batches:
            texts = [None if i is None else known.decode(np.array(i, np.int64)).decode("utf-8", "replace") for i in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(back, schema)


def op6_pieces(spark, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to the document."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")
