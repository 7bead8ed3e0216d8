"""Targets that are folders of Parquet files: full, append and upsert writes.

A target is an ordinary Parquet table with two partition columns: the run that brought a row,
and a hash bucket of its key.

* A *full* write replaces all partitions, an *append* those of its own run.  So a repeated append
  takes effect once, whatever happened to the target in between.
* An *upsert* meets only the buckets that its batch touches, pruned by partition, and replaces
  just these; rows keep the run that brought them, new rows belong to the upsert.

Every write first stores its partitions beside the current ones, then names them in one step
file, then moves them into place.  A write that dies before its step file changed nothing; one that
dies later is finished by the next write.  Readers do not wait for writers: who needs a
snapshot reads a copy.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError, RowtideError
from rowtide.operators import upsert as U
from rowtide.operators.mapping import project
from rowtide.operators.ranking import upsert_rows
from rowtide.plans.sizing import BROADCAST_ROWS, broadcast_threshold, scan_bytes
from rowtide.sources.storage import Storage

TABLE, STEP, PENDING = "_TABLE", "_STEP", "_pending"
RUN, BUCKET = "rt_run", "rt_bucket"

#: Buckets of a new target with a key: this many at least, and one for so many bytes.
LEAST_BUCKETS = 8
BUCKET_BYTES = 256 << 20


@dataclass(frozen=True)
class Layout:
    """The columns of a target, and by which keys its rows are dealt into how many buckets."""

    schema: T.StructType
    keys: tuple[str, ...] = ()
    buckets: int = 1
    serial: int = 0

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "keys": self.keys, "buckets": self.buckets, "serial": self.serial})

    @staticmethod
    def parse(text: str) -> Layout:
        doc = json.loads(text)
        return Layout(T.StructType.fromJson(doc["schema"]), tuple(doc["keys"]), doc["buckets"], doc["serial"])

    @property
    def stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(RUN, T.StringType()), T.StructField(BUCKET, T.IntegerType())])

    def bucket(self) -> Column:
        """The bucket of a row; rows without a key, which match nothing, are spread."""
        if not self.keys or self.buckets == 1:
            return F.lit(0)
        hashed = [V.col(f.name) for f in self.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
        missing = V.col(self.keys[0]).isNull()
        for k in self.keys[1:]:
            missing = missing | V.col(k).isNull()
        code = F.when(missing, F.xxhash64(*hashed)).otherwise(F.xxhash64(*[V.col(k) for k in self.keys]))
        return F.pmod(code, F.lit(self.buckets)).cast("int")


def layout_of(spark: SparkSession, path: str) -> Layout | None:
    storage = Storage(spark)
    if not storage.exists(f"{path}/{TABLE}"):
        return None
    return Layout.parse(storage.read_text(f"{path}/{TABLE}"))


def is_target(spark: SparkSession, path: str) -> bool:
    """Whether a sink has written ``path``, or was about to finish writing it."""
    return any(Storage(spark).exists(f"{path}/{name}") for name in (TABLE, STEP))


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a target."""
    sink = PathSink(spark, path)
    sink.recover()
    layout = layout_of(spark, sink.path)
    if layout is None:
        raise RowtideError(f"{path} has never been written")
    return sink.rows(layout).select(*[V.col(c) for c in layout.schema.names])


@dataclass
class PathSink:
    """One target folder.

    ``keys`` and ``order`` serve upserts; ``buckets`` is their number in a new target, by
    default as many as its first rows need.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    buckets: int | None = None

    def __post_init__(self) -> None:
        self.path = self.path.rstrip("/")
        self.storage = Storage(self.spark)

    def write(self, df: DataFrame, mode: str, run_id: str) -> int:
        """Write ``df``; the number of rows written."""
        if mode == "full":
            return self.full(df, run_id)
        if mode == "append":
            return self.append(df, run_id)
        if mode == "upsert":
            return self.upsert(df, run_id)
        raise ConfigError(f"unknown sync mode {mode!r}")

    def full(self, df: DataFrame, run_id: str) -> int:
        """Replace the contents, also by nothing."""
        before = self.opened()
        after = self._layout(df, before)
        return self._put(before, after, self._dealt(df, after, f"f-{run_id}"), whole=True)

    def append(self, df: DataFrame, run_id: str) -> int:
        """Add the rows; they replace those of an earlier append of the same run."""
        before = self.opened()
        after = before or self._layout(df, None)
        unknown = [c for c in df.columns if c not in after.schema.names]
        if unknown:
            raise ConfigError(f"append: {self.path} has no column(s) {unknown}")
        return self._put(before, after, self._dealt(_conform(df, after.schema), after, f"a-{run_id}"), run=f"a-{run_id}")

    def upsert(self, df: DataFrame, run_id: str) -> int:
        """Merge by key; of several rows of one key the last in ``order`` counts.

        The batch is stored first: its true size decides how it meets the touched buckets.
        """
        if not self.keys:
            raise ConfigError(f"upsert into {self.path} needs key columns")
        before, batch = self.opened(), upsert_rows(df, self.keys, self.order)
        if before is None:
            after = self._layout(df, None)
            return self._put(None, after, self._dealt(batch, after, f"u-{run_id}"), run=f"u-{run_id}")
        folder = self._fresh("batch", run_id)
        try:
            batch.write.parquet(folder)
            source = self.spark.read.schema(batch.schema).parquet(folder)
            rows = source.count()
            if rows:
                self._merge(before, source, rows, self.storage.size(folder), run_id)
            return rows
        finally:
            self.storage.delete(folder)

    def _merge(self, before: Layout, source: DataFrame, rows: int, size: int, run_id: str) -> None:
        same = before.keys == tuple(self.keys)
        after = before if same else Layout(before.schema, tuple(self.keys), self._buckets(self.rows(before)), before.serial)
        target = self.rows(before)
        if same:
            # Keys are hashed as the target has them.
            as_target = source.select(*[V.col(k).cast(V.column_type(target, k)).alias(k) for k in self.keys])
            key_code = F.pmod(F.xxhash64(*[V.col(k) for k in self.keys]), F.lit(after.buckets)).cast("int")
            # At most as many as there are buckets.
            touched = [r[0] for r in as_target.select(key_code.alias("b")).distinct().collect()]
            target = target.where(F.col(BUCKET).isin(touched if after.buckets > 1 else [0]))
        small = size <= broadcast_threshold(self.spark) and rows <= BROADCAST_ROWS
        merged = U.merge(target, source, self.keys, small_source=small)
        bucket = F.coalesce(F.col(BUCKET), after.bucket()) if same else after.bucket()
        merged = merged.withColumns({RUN: F.coalesce(RUN, F.lit(f"u-{run_id}")), BUCKET: bucket})
        self._put(before, after, _together(merged, after), whole=not same)

    def rows(self, layout: Layout) -> DataFrame:
        """The rows with their partition columns."""
        return self.spark.read.schema(layout.stored).parquet(self.path)

    def _layout(self, df: DataFrame, before: Layout | None) -> Layout:
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        taken = [c for c in schema.names if c.lower() in (RUN, BUCKET)]
        if taken:
            raise ConfigError(f"{self.path}: column(s) {taken} have names that a target folder needs itself")
        keys = tuple(k for k in self.keys if k in schema.names)
        return Layout(schema, keys, self._buckets(df) if keys else 1, before.serial if before else 0)

    def _buckets(self, df: DataFrame) -> int:
        return self.buckets or max(LEAST_BUCKETS, -(-(scan_bytes(df) or 0) // BUCKET_BYTES))

    def _dealt(self, df: DataFrame, layout: Layout, run: str) -> DataFrame:
        return _together(df.withColumns({RUN: F.lit(run), BUCKET: layout.bucket()}), layout)

    # ---- steps -------------------------------------------------------------

    def _fresh(self, kind: str, run_id: str) -> str:
        return f"{self.path}/{PENDING}/{kind}-{run_id}-{uuid.uuid4().hex[:8]}"

    def opened(self) -> Layout | None:
        """The layout, after finishing what an earlier write left."""
        self.recover()
        return layout_of(self.spark, self.path)

    def recover(self) -> None:
        """Finish a write that died after its step file."""
        if self.storage.exists(f"{self.path}/{STEP}"):
            self._finish(json.loads(self.storage.read_text(f"{self.path}/{STEP}")))

    def _put(self, before: Layout | None, after: Layout, df: DataFrame, whole: bool = False, run: str | None = None) -> int:
        """Replace partitions by those of ``df``: all, or those of a run, or those that ``df`` has."""
        folder = self._fresh("put", run or "all")
        try:
            df.write.partitionBy(RUN, BUCKET).parquet(folder)
            # Answered from the files' footers.
            rows = self.spark.read.schema(after.stored).parquet(folder).count()
            runs = [n for n in self.storage.list(folder) if n.startswith(f"{RUN}=")]
            step = {"folder": folder.rsplit("/", 1)[1], "whole": whole, "run": run, "runs": runs, "layout": after.text()}
            if not self.storage.create_text(f"{self.path}/{STEP}", json.dumps(step)):
                raise RowtideError(f"{self.path} is being written by another run")
            now = layout_of(self.spark, self.path)
            if (now and now.serial) != (before and before.serial):
                self.storage.delete(f"{self.path}/{STEP}")
                raise RowtideError(f"{self.path} was written by another run meanwhile")
        except BaseException:
            self.storage.delete(folder)
            raise
        self._finish(step)
        return rows

    def _finish(self, step: dict) -> None:
        """Move the partitions of a step into place; may be repeated at any point."""
        folder = f"{self.path}/{PENDING}/{step['folder']}"
        for run in [n for n in self.storage.list(self.path) if n.startswith(f"{RUN}=")]:
            if (step["whole"] or run == f"{RUN}={step['run']}") and run not in step["runs"]:
                self.storage.delete(f"{self.path}/{run}")
        for run in [n for n in self.storage.list(folder) if n.startswith(f"{RUN}=")]:
            made, there = self.storage.list(f"{folder}/{run}"), self.storage.list(f"{self.path}/{run}")
            if step["whole"] or step["run"] or not there:
                self.storage.replace_dir(f"{folder}/{run}", f"{self.path}/{run}")
                continue
            for bucket in made:
                self.storage.replace_dir(f"{folder}/{run}/{bucket}", f"{self.path}/{run}/{bucket}")
        layout = Layout.parse(step["layout"])
        self.storage.replace_text(f"{self.path}/{TABLE}", Layout(layout.schema, layout.keys, layout.buckets, layout.serial + 1).text())
        self.storage.delete(f"{self.path}/{STEP}")
        self.storage.delete(folder)

    def vacuum(self, keep_hours: float = 168) -> None:
        """Remove what writes that died before their step file left, once it is older than ``keep_hours``."""
        self.recover()
        for name in self.storage.list(f"{self.path}/{PENDING}"):
            if self.storage.age(f"{self.path}/{PENDING}/{name}") >= keep_hours * 3600:
                self.storage.delete(f"{self.path}/{PENDING}/{name}")


def _together(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows of a bucket in few files; large buckets are split, small ones share a task."""
    return df.hint("rebalance", BUCKET) if layout.buckets > 1 else df


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``."""
    padded: DataFrame = project(df, schema.names)
    return padded.select(*[padded[i].cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def partitions(spark: SparkSession, path: str) -> dict[str, Sequence[str]]:
    """Names of the data files of each partition, to see what a write touched."""
    storage, out = Storage(spark), {}
    for run in [n for n in storage.list(path) if n.startswith(f"{RUN}=")]:
        for bucket in storage.list(f"{path}/{run}"):
            out[f"{run}/{bucket}"] = [n for n in storage.list(f"{path}/{run}/{bucket}") if n.endswith(".parquet")]
    return out
