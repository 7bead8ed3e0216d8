"""What the operators of this package share: stored frames, folds, samples, word tables."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.storage import Storage, fresh_dir

#: Bytes of text handled at once inside a task; a longer text is one chunk of its own.
CHUNK_CHARS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, tasks: int | None = None, compression: str | None = None, group: int | None = None) -> DataFrame:
    """``df``, written to the folder all executors share and read back: lineage ends there.

    ``tasks``: of how many files at most, where few rows are known to come.  ``group``: about how many
    bytes are written and read at once, where rows are large: Parquet looks after 100 rows otherwise.
    """
    path = fresh_dir(df.sparkSession, name)
    looks = {"parquet.block.size": group, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1} if group else {}
    (df.coalesce(tasks) if tasks else df).write.options(**looks).parquet(path, compression=compression)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def forget(df: DataFrame) -> None:
    """Delete what ``stored`` wrote."""
    Storage(df.sparkSession).delete(df.stored_at)


class Scratch:
    """Stored frames that go together once what follows from them is stored."""

    def __init__(self) -> None:
        self.made: list[DataFrame] = []

    def __call__(self, df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
        self.made.append(stored(df, name, tasks))
        return self.made[-1]

    def clear(self) -> None:
        while self.made:
            forget(self.made.pop())


#: Keys that are broadcast, at 16 bytes each.
BROADCAST_KEYS = 1_000_000


def small(keys: DataFrame) -> DataFrame:
    """Stored ``keys``, broadcast if they are counted to be few; joined by a shuffle otherwise."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def unused(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns of these names, which a result is about to take."""
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in names])


def plain(df: DataFrame, *keep: str) -> DataFrame:
    """``df`` with numbered names but for ``keep``: Python code takes no name with a dot.  ``toDF`` brings them back."""
    return df.toDF(*[c if c in keep else f"column_{n}" for n, c in enumerate(df.columns)])


def id_crc(column: str | Column = "doc_id") -> Column:
    """crc32 of an id as text; null for a null id."""
    return F.crc32((F.col(column) if isinstance(column, str) else column).cast("string").cast("binary"))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    slow = F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.length(column) == F.octet_length(column), F.lower(column)).otherwise(slow)


def labelled_ids(labels: DataFrame, label: str, keep: Column, bound: int | None = None) -> DataFrame:
    """(doc_id, label) of all rows, or of at most ``bound`` for each of the two labels, in hash order.

    ``keep`` admits ids.  A doc_id labelled twice counts once, with the larger label.  With a bound the
    result has at most ``2 * bound`` rows, so it may be broadcast.
    """
    known = (
        labels.where(keep & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    if bound is None:
        return known
    parts = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


class Index(dict):
    """Numbers words in order of appearance."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.fresh.append(word)
        return n


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as counted, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def busiest(hits: np.ndarray, most: int) -> np.ndarray:
    """Ascending places of at most ``most`` numbers: those of two or more, the largest first."""
    at = np.flatnonzero(hits >= 2)
    if len(at) > most:
        at = at[np.argpartition(-hits[at], most)[:most]]
    return np.sort(at)


class WordTable:
    """One row of numbers per distinct word, computed when the word is first met.

    ``rows`` maps new words to their rows.  Beyond ``limit`` words the table keeps those met
    most often at the next chunk, so a worker's memory is bounded whatever the vocabulary.
    """

    def __init__(self, rows: Callable[[list[str]], np.ndarray], limit: int = 200_000):
        self.compute, self.limit = rows, limit
        self.index, self.values, self.hits = Index(), None, np.zeros(0, np.int64)

    def begin(self) -> None:
        """Call between chunks: ids handed out before may no longer hold."""
        if len(self.index) > self.limit:
            keep, words = busiest(self.hits, self.limit // 2), list(self.index)
            self.index = Index()
            for n in keep.tolist():
                self.index[words[n]]
            self.index.fresh = []
            self.values, self.hits = self.values[keep], np.zeros(len(keep), np.int64)

    def ids(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if fresh := self.index.fresh:
            made, first = self.compute(fresh), len(self.index) - len(fresh)
            need = len(self.index)
            if self.values is None:
                self.values = np.zeros((max(1024, need), made.shape[1]), made.dtype)
            elif need > len(self.values):
                grown = np.zeros((max(need, 2 * len(self.values)), made.shape[1]), made.dtype)
                grown[:first] = self.values[:first]
                self.values = grown
            self.values[first:need] = made
            self.index.fresh = []
        hits = np.bincount(found, minlength=len(self.index))
        hits[: len(self.hits)] += self.hits
        self.hits = hits
        return found


def words_of(texts: Iterable[str | None], pattern: re.Pattern | None, lower: bool = False) -> tuple[list[str], np.ndarray]:
    """All words one after the other, and how many each text has; pattern None: split at white space."""
    words: list[str] = []
    counts = []
    for text in texts:
        text = text or ""
        if lower:
            text = text.lower()
        got = pattern.findall(text) if pattern else text.split()
        words += got
        counts.append(len(got))
    return words, np.array(counts, np.int64)


def group_sum(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of ``counts`` rows; zero for an empty group."""
    out = np.zeros((len(counts), *values.shape[1:]), np.float64)
    full = counts > 0
    if full.any():
        starts = np.concatenate(([0], np.cumsum(counts)))[:-1][full]
        out[full] = np.add.reduceat(values, starts, axis=0, dtype=np.float64)
    return out


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after the other, and each word's length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32), lengths


def mix(h: np.ndarray) -> np.ndarray:
    """A good spread of the bits of unsigned 64-bit numbers."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def slices_of(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches in pieces of about ``most`` bytes of text (column ``text``); a longer text is one of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        whole = np.cumsum(sizes, dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(whole)) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if end > start:
                yield batch.slice(start, end - start)
    give_back()


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Arrow batches in pieces of bounded text, each with its texts (column ``text``)."""
    for part in slices_of(batches, CHUNK_CHARS):
        yield part, part.column("text").to_pylist()


#: Spark's bound of an Arrow batch, and what it is here unless the session sets it.
ARROW_BYTES, ARROW_MOST = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def in_batches(docs: DataFrame, each: Callable, schema) -> DataFrame:
    """``docs.mapInArrow`` in batches of bounded bytes; the bound stays set in the session.

    Every task holds a batch up to twice in the JVM, while its vectors grow, and once in Python.
    """
    conf = docs.sparkSession.conf
    if ARROW_BYTES not in conf.getAll:
        conf.set(ARROW_BYTES, ARROW_MOST)
    return docs.mapInArrow(each, schema)


def give_back() -> None:
    """Return what Arrow and the C library hold but do not use: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    # Python's list and word tables, and numpy's arrays, go back to the C library, which keeps them (glibc).
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)
