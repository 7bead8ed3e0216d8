"""High-water marks of a job, kept between runs.

Every commit adds one small file with all marks of the job, typed; the newest one
counts.  A mark is committed only after the rows it covers are written.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import StateError
from rowtide.operators.watermark import advanced
from rowtide.sources.storage import Storage

HISTORY = 20


def safe_name(job: str) -> str:
    """A job's name as a folder name."""
    return re.sub(r"[^A-Za-z0-9]", "_", job)


def encode(value: Any, dtype: T.DataType) -> dict[str, Any]:
    if isinstance(value, (dt.date, dt.datetime)):
        text = value.isoformat()
    elif isinstance(value, (bytes, bytearray)):
        text = bytes(value).hex()
    else:
        text = str(value) if not isinstance(value, float) else repr(value)
    return {"type": dtype.simpleString(), "value": text}


def decode(doc: Mapping[str, Any]) -> V.Constant:
    dtype = T._parse_datatype_string(doc["type"]) if doc["type"] != "void" else T.StringType()
    text = doc["value"]
    kind = V.value_class(dtype)
    if kind == V.BOOL:
        return V.Constant(text == "True", dtype)
    if kind == V.DATE:
        whole = dt.datetime.fromisoformat(text)
        return V.Constant(whole.date() if isinstance(dtype, T.DateType) else whole, dtype)
    if kind == V.BYTES:
        return V.Constant(bytearray.fromhex(text), dtype)
    if kind == V.NUMBER:
        if isinstance(dtype, T.DecimalType):
            return V.Constant(Decimal(text), dtype)
        return V.Constant(float(text) if V.is_floating(dtype) else int(text), dtype)
    return V.Constant(text, dtype)


@dataclass
class StateStore:
    """Marks of one job under ``root``."""

    spark: SparkSession
    root: str
    job: str

    def __post_init__(self) -> None:
        self.storage = Storage(self.spark)
        self.folder = f"{self.root.rstrip('/')}/{safe_name(self.job)}"

    def _commits(self) -> list[str]:
        return [n for n in self.storage.list(self.folder) if re.fullmatch(r"\d{12}\.json", n)]

    def load(self) -> dict[str, V.Constant]:
        """The committed marks; none before the first run."""
        commits = self._commits()
        if not commits:
            return {}
        try:
            doc = json.loads(self.storage.read_text(f"{self.folder}/{commits[-1]}"))
            if doc["job"] != self.job:
                raise StateError(f"state folder {self.folder} belongs to job {doc['job']!r}")
            return {k: self._instant(decode(v)) for k, v in doc["marks"].items()}
        except (KeyError, ValueError) as e:
            raise StateError(f"unreadable state {self.folder}/{commits[-1]}: {e}") from e

    def _instant(self, mark: V.Constant) -> V.Constant:
        """A mark of an earlier release, in local time, as the instant the session reads it as."""
        if not isinstance(mark.dtype, T.TimestampType) or mark.value is None or mark.value.tzinfo is not None:
            return mark
        local = F.unix_micros(F.lit(mark.text()).cast("timestamp"))
        return V.Constant(V.instant(self.spark.range(1).select(local).first()[0]), mark.dtype)

    def commit(self, marks: Mapping[str, V.Constant], run_id: str) -> dict[str, V.Constant]:
        """Advance the stored marks; a mark never moves down.

        Of two runs that commit at once one gets its number; the other fails and changes nothing.
        """
        commits = self._commits()
        merged = self.load()
        for key, new in marks.items():
            old = merged.get(key)
            if new.value is None:
                continue
            if old is None or advanced(old.value, new.value) != old.value:
                merged[key] = new
        doc = {
            "job": self.job,
            "run_id": run_id,
            "marks": {k: encode(c.value, c.dtype) for k, c in merged.items()},
        }
        serial = int(commits[-1][:12]) + 1 if commits else 1
        self.storage.make_dirs(self.folder)
        if not self.storage.create_text(f"{self.folder}/{serial:012d}.json", json.dumps(doc, sort_keys=True)):
            raise StateError(f"job {self.job!r}: another run has committed its marks meanwhile")
        for old_name in commits[:-HISTORY]:
            self.storage.delete(f"{self.folder}/{old_name}")
        return merged

    def reset(self) -> None:
        """Forget everything: the next run is a first run."""
        self.storage.delete(self.folder)
