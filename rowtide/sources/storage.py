"""Small files on any file system Spark can reach: pointers, state, listings.

Only metadata goes through here; table data is read and written by executors.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from rowtide.errors import RowtideError


class Storage:
    """Driver-side access through the cluster's own Hadoop file system layer."""

    def __init__(self, spark: SparkSession):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def list(self, path: str) -> list[str]:
        """Names of the entries of a directory; none if it does not exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs(path).listStatus(self._path(path)))

    def size(self, path: str) -> int:
        """Bytes under ``path``."""
        return int(self._fs(path).getContentSummary(self._path(path)).getLength())

    def age(self, path: str) -> float:
        """Seconds since ``path`` itself was last changed."""
        status = self._fs(path).getFileStatus(self._path(path))
        return time.time() - status.getModificationTime() / 1000

    def make_dirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def replace_text(self, path: str, text: str) -> None:
        """Write ``path`` so that readers see either the old or the new text."""
        self._move(self._written(path, text), path, "OVERWRITE")

    def create_text(self, path: str, text: str) -> bool:
        """Write ``path`` if nobody has: whole or not at all.  False if it exists."""
        made = self._written(path, text)
        try:
            self._move(made, path, "NONE")
            return True
        except Exception as e:
            self.delete(made)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def replace_dir(self, made: str, path: str) -> None:
        """Move the folder ``made`` to ``path``, in place of what is there."""
        fs, target = self._fs(path), self._path(path)
        fs.delete(target, True)
        fs.mkdirs(target.getParent())
        if not fs.rename(self._path(made), target):
            raise RowtideError(f"cannot move {made} to {path}")

    def _written(self, path: str, text: str) -> str:
        temp = f"{path}.{uuid.uuid4().hex}.tmp"
        out = self._fs(path).create(self._path(temp), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        return temp

    def _move(self, made: str, path: str, how: str) -> None:
        target, fs = self._path(path), self.jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(target.toUri(), self.conf) if target.toUri().getScheme() else (
            fs.FileContext.getFileContext(self.conf)
        )
        kind = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self.jvm.java.lang.reflect.Array.newInstance(kind, 1)
        options[0] = getattr(getattr(fs, "Options$Rename"), how)
        context.rename(self._path(made), target, options)


def scratch_root(spark: SparkSession) -> str:
    """A folder all executors share: the one the cluster names.

    Sessions that name none must run in one process, as tests do: there a temporary folder is
    shared too.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    made = tempfile.mkdtemp(prefix="rowtide-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared scratch folder."""
    return f"{scratch_root(spark)}/rowtide/{name}-{uuid.uuid4().hex}"


@dataclass
class Staging:
    """Frames stored for the time of one run, in the folder that all executors share.

    A stored frame is computed once, keeps its rows if executors are lost, and has a
    size that the optimizer knows.
    """

    spark: SparkSession
    run_id: str
    made: list[str] = field(default_factory=list)

    def __call__(self, df: DataFrame, by: str | None = None) -> DataFrame:
        path = fresh_dir(self.spark, f"stage-{self.run_id}")
        self.made.append(path)
        df.write.parquet(path, partitionBy=by)
        return self.spark.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *failure: object) -> None:
        for path in self.made:
            Storage(self.spark).delete(path)
