"""Token ids of a corpus as succinct shard files.

Documents are range-partitioned and sorted by id, encoded, and cut into shards of about
``SHARD_TOKENS`` ids; each shard is one compressed wavelet matrix (``wavelet.py``) beside the
ids and lengths of its documents, a row of a Parquet table that Spark writes.  Tokens can be
read, counted and looked up from a shard alone.  A document is never split over shards.

A task holds one shard at a time.  To the driver comes one number per partition, from which
every document's position in the whole sequence follows.

Null text is empty; each document ends with the end id.  Documents with equal ids (also null
ids, which come first) are in the order of their texts; repeated rows stay.  Extra columns
are ignored.  An empty table gives no shards.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm.common import busiest, group_sum, ranges, slices_of, table
from rowtide.llm.wavelet import WaveletMatrix
from rowtide.sources.storage import fresh_dir

SHARD_TOKENS = 1 << 20
#: Bytes of text encoded at once: each distinct word in them is looked up once.
TEXT_BYTES = 16 << 20
#: Distinct words that a worker remembers, and their bytes; of these it keeps half as many, none longer than WORD_BYTES.
WORDS, KNOWN_BYTES, WORD_BYTES = 600_000, 64 << 20, 128
#: Words whose ids are put in place at once.
PLACED = 1 << 18
SHARDS = "part int, start long, n_tokens long, doc_ids array<long>, lengths array<long>, matrix binary"
ROWS = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]
#: Letters in every version of Unicode in use: the library always cuts where a run of them meets a mark or a line end.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ʯΑ-ΡΣ-ώЀ-ҁҊ-ԯ", ".,;:!?"
#: Words of letters and marks, perhaps over a line end; one of letters alone is no such word.
SHAPE = rf"^(?P<a>[{LETTERS}]+)(?P<b>[{MARKS}]*)(?P<c>\n?)(?P<d>[{LETTERS}]*)(?P<e>[{MARKS}]*)\z"
SHAPED = rf"^[{LETTERS}]+(?:[{MARKS}]+\n?|\n)[{LETTERS}]*[{MARKS}]*\z"


def literal(text: str) -> str:
    """A regular expression of Arrow that matches just ``text``."""
    return "".join(rf"\x{{{ord(c):x}}}" for c in text)


class Encoder:
    """Token ids by the tokenizers library, remembering words met before.

    A byte-level tokenizer never joins a space to what stands before it, unless that is white
    space too.  So a text without such a pair is the sequence of its words, each with the space
    before it.  Words of letters and marks fall into parts in the same way.  Arrow finds the distinct
    ones, and new ones are encoded many at a time.  Other texts, and other kinds of tokenizer, go
    through the library whole.

    ``known`` holds words that follow a space, as they are; a space before one says that it
    follows none, and two spaces are the end of a text.
    """

    def __init__(self, path: str, end: int = 0):
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and spec["model"]["type"] == "BPE" and not spec.get("truncation") and not spec.get("padding")
        )
        special = [t["content"] for t in spec.get("added_tokens") or []]
        #: What a text has that must go through the library whole.
        self.apart = "|".join([f"[{literal(WHITE)}] ", *map(literal, special)])
        size = self.tokenizer.get_vocab_size()
        self.bits = max(1, (max(size, end + 1) - 1).bit_length())
        self.kind = np.uint16 if self.bits <= 16 else np.uint32
        self.opens = np.array([(self.tokenizer.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.known, self.hits = pa.array([], pa.string()), np.zeros(0, np.int64)
        self.starts, self.lengths, self.flat, self.used = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.kind), 0

    def _forget(self) -> None:
        """Keep the words met most often, but no long ones."""
        short = pc.binary_length(self.known).to_numpy() <= WORD_BYTES
        keep = busiest(np.where(short, self.hits, 0), WORDS // 2)
        self.known, self.hits = self.known.take(pa.array(keep)), np.zeros(len(keep), np.int64)
        self.flat, self.lengths = self.flat[ranges(self.starts[keep], self.lengths[keep])], self.lengths[keep]
        self.starts, self.used = np.cumsum(self.lengths) - self.lengths, len(self.flat)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, fresh: list[str]) -> None:
        """Ids of new words, the last of ``known``."""
        first, need = len(self.known) - len(fresh), len(self.known)
        if need > len(self.starts):
            more = np.zeros(max(need, 2 * first) - len(self.starts), np.int64)
            self.starts, self.lengths = np.concatenate([self.starts, more]), np.concatenate([self.lengths, more])
        joined = [i for i, w in enumerate(fresh) if w and w[0] != " " and not w[-1].isspace()]
        for at in range(0, len(joined), 4000):
            group = joined[at : at + 4000]
            runs = ["".join([f" {fresh[i]}" for i in group[j : j + 50]]) for j in range(0, len(group), 50)]
            ids = np.fromiter(chain.from_iterable(self._library(runs)), self.kind)
            cuts = np.flatnonzero(self.opens[ids])
            self._keep(first + np.array(group), np.diff(cuts, append=len(ids)), ids)
        others = sorted(set(range(len(fresh))).difference(joined))
        for at in range(0, len(others), 100):
            group = others[at : at + 100]
            made = self._library([w[1:] if (w := fresh[i])[:1] == " " else f" {w}" for i in group])
            made = [[self.end] if fresh[i] == "  " else ids for i, ids in zip(group, made, strict=True)]
            self._keep(first + np.array(group), np.fromiter(map(len, made), np.int64, len(made)), np.fromiter(chain.from_iterable(made), self.kind))

    def _keep(self, words: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        """``ids`` are those of ``words``, one word after the other."""
        self.starts[words], self.lengths[words] = self.used + np.cumsum(lengths) - lengths, lengths
        if self.used + len(ids) > len(self.flat):
            grown = np.zeros(max(2 * len(self.flat), self.used + len(ids)), self.kind)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where words stand among the known ones, which new ones join."""
        if len(self.known) > WORDS or self.known.nbytes > KNOWN_BYTES:
            self._forget()
        before = len(self.known)
        found = pa.concat_arrays([self.known, words]).dictionary_encode()
        if fresh := found.dictionary.slice(before).to_pylist():
            self.known, self.hits = found.dictionary, np.concatenate([self.hits, np.zeros(len(fresh), np.int64)])
            self._learn(fresh)
        return found.indices.to_numpy()[before:]

    def _ids(self, words: pa.Array, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of distinct words, which occur so many times, and their number for each word."""
        shaped = pc.match_substring_regex(words, SHAPED).to_numpy(zero_copy_only=False)
        shapes = pc.extract_regex(words.filter(pa.array(shaped)), SHAPE).flatten()
        parts = [words.filter(pa.array(~shaped)), shapes[0], *[pc.binary_join_element_wise("", part, " ") for part in shapes[1:]]]
        places = self._places(pa.concat_arrays(parts))
        counts = np.where(shaped, len(shapes), 1)
        at = np.zeros(counts.sum(), np.int64)
        one = np.repeat(~shaped, counts)
        at[one] = places[: len(parts[0])]
        at[~one] = places[len(parts[0]) :].reshape(len(shapes), -1).T.ravel()
        self.hits += np.bincount(at, np.repeat(times, counts), len(self.hits)).astype(np.int64)
        lengths = self.lengths[at]
        return self.flat[ranges(self.starts[at], lengths)], group_sum(lengths, counts).astype(np.int64)

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` for texts that are the sequences of their words."""
        if not len(texts):
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        split = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(split).to_numpy().astype(np.int64) + 1
        ends = np.cumsum(counts) - 1
        starts, words = ends - counts + 1, split.flatten()
        opens = np.zeros(len(words), bool)
        opens[starts - np.arange(len(texts))] = True
        first = pc.binary_join_element_wise("", words.filter(pa.array(opens)), " ")
        words = pa.concat_arrays([words.filter(pa.array(~opens)), first, pa.array(["  "], words.type)]).dictionary_encode()
        found = words.indices.to_numpy()
        at = np.full(ends[-1] + 1, found[-1])
        inside = np.ones(len(at), bool)
        inside[starts] = inside[ends] = False
        at[inside], at[starts] = found[: -len(texts) - 1], found[-len(texts) - 1 : -1]
        ids, lengths = self._ids(words.dictionary, np.bincount(at, minlength=len(words.dictionary)))
        begins, placed = np.cumsum(lengths) - lengths, []
        for n in range(0, len(at), PLACED):
            some = at[n : n + PLACED]
            placed.append(ids[ranges(begins[some], lengths[some])])
        return np.concatenate(placed), group_sum(lengths[at], counts).astype(np.int64)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, each with the end id, and their number for each text."""
        texts = texts.cast(pa.string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if self.by_word:
            whole = pc.match_substring_regex(texts, self.apart).to_numpy(zero_copy_only=False)
        else:
            whole = np.ones(len(texts), bool)
        if not whole.any():
            return self._by_word(texts)
        ids, counts = self._by_word(texts.filter(pa.array(~whole)))
        alone = [np.array([*self._library([t])[0], self.end], self.kind) for t in texts.filter(pa.array(whole)).to_pylist()]
        lengths = np.zeros(len(texts), np.int64)
        lengths[~whole], lengths[whole] = counts, list(map(len, alone))
        order = np.argsort(whole, kind="stable")
        starts = np.zeros(len(texts), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.concatenate([ids, *alone])[ranges(starts, lengths)], lengths


@lru_cache(maxsize=1)
def encoder_of(path: str, end: int) -> Encoder:
    """A worker's encoder; the words it has met serve its later tasks too.

    Spark runs a task on every core, so the library gets no threads of its own; they would mostly wait, and spin meanwhile.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path, end)


def write_shards(docs: DataFrame, path: str, tokenizer: str, end: int = 0, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``docs`` (doc_id, text) and write shards in order of doc_id to the table at ``path``."""

    def shard(part: int, start: int, doc_ids: list, ids: np.ndarray, lengths: np.ndarray, bits: int) -> pa.RecordBatch:
        row = {"part": part, "start": start, "n_tokens": len(ids), "doc_ids": doc_ids, "lengths": lengths.tolist(), "matrix": WaveletMatrix.build(ids, bits).to_bytes()}
        return pa.RecordBatch.from_pylist([row], schema=pa.schema([("part", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("matrix", pa.binary())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = encoder_of(tokenizer, end), TaskContext.get().partitionId(), 0
        doc_ids, ids, lengths, held = [], [], [], 0
        for batch in slices_of(batches, TEXT_BYTES):
            more, counts = encoder.encode(pc.fill_null(batch.column("text"), ""))
            doc_ids += batch.column("doc_id").to_pylist()
            ids.append(more)
            lengths.append(counts)
            held += len(more)
            while held >= shard_tokens:
                every, sizes = np.concatenate(ids), np.concatenate(lengths)
                n = int(np.searchsorted(np.cumsum(sizes), shard_tokens)) + 1
                cut = int(sizes[:n].sum())
                yield shard(part, start, doc_ids[:n], every[:cut], sizes[:n], encoder.bits)
                start, held = start + cut, held - cut
                doc_ids, ids, lengths = doc_ids[n:], [every[cut:]], [sizes[n:]]
        if doc_ids:
            yield shard(part, start, doc_ids, np.concatenate(ids), np.concatenate(lengths), encoder.bits)

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, SHARDS).write.option("parquet.block.size", str(16 << 20)).parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(T._parse_datatype_string(SHARDS)).parquet(path)


def documents_of(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the shards."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("part", "start", "doc_ids", "lengths", "matrix")}
                data = WaveletMatrix.from_bytes(row["matrix"].as_py()).tokens().astype("<u4").tobytes()
                lengths = np.array(row["lengths"].as_py(), np.int64)
                starts = np.cumsum(lengths) - lengths
                sums = [zlib.crc32(memoryview(data)[4 * s : 4 * (s + n)]) for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), row["part"].as_py(), np.int32)),
                        pa.array(row["doc_ids"].as_py(), pa.int64()),
                        pa.array(starts + row["start"].as_py()),
                        pa.array(lengths),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One row per partition.
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    first, done = {}, 0
    for part in sorted(totals):
        first[part], done = done, done + totals[part]
    spark = shards.sparkSession
    offsets = spark.createDataFrame(list(first.items()), "part int, first long")
    rows = shards.mapInArrow(decode, ROWS).join(F.broadcast(offsets), "part")
    return rows.select("doc_id", (F.col("start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")


def op7_token_file(spark, sf_dir: str) -> DataFrame:
    """Encode all documents, write the shards, and read every document back from them."""
    import public_tokenizers

    path = fresh_dir(spark, "token-shards")
    write_shards(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return documents_of(read_shards(spark, path))
