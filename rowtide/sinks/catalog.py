"""Targets that are tables of Spark's catalogue.

Full and append writes work for every table format; upserts need one that supports
row-level changes, which then rewrites only the files that hold matching rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rowtide.errors import ConfigError
from rowtide.operators.ranking import upsert_rows
from rowtide.sources.storage import Staging
from rowtide.types import quoted


def merge_sql(table: str, view: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """One ``MERGE INTO``; columns that the batch lacks keep their values."""
    on = " AND ".join(f"t.{quoted(k)} = s.{quoted(k)}" for k in keys)
    sets = ", ".join(f"t.{quoted(c)} = s.{quoted(c)}" for c in columns if c not in keys)
    matched = f" WHEN MATCHED THEN UPDATE SET {sets}" if sets else ""
    names = ", ".join(quoted(c) for c in columns)
    values = ", ".join(f"s.{quoted(c)}" for c in columns)
    return (
        f"MERGE INTO {table} t USING {view} s ON {on}{matched} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


@dataclass
class CatalogSink:
    """A catalogue table, by its full name as SQL text."""

    spark: SparkSession
    table: str
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()

    def write(self, df: DataFrame, mode: str, run_id: str) -> int:
        if mode == "upsert" and not self.keys:
            raise ConfigError(f"upsert into {self.table} needs key columns")
        if mode not in ("full", "append", "upsert"):
            raise ConfigError(f"unknown sync mode {mode!r}")
        if mode == "upsert":
            df = upsert_rows(df, self.keys, self.order)
        # Stored first: counted exactly, computed once, and a table may be its own source.
        with Staging(self.spark, run_id) as stage:
            stored = stage(df)
            # Several targets of one run may be written at the same time.
            view = "rt_batch_" + uuid.uuid4().hex
            stored.createOrReplaceTempView(view)
            try:
                if mode == "upsert":
                    self.spark.sql(merge_sql(self.table, view, stored.columns, self.keys))
                else:
                    verb = "OVERWRITE" if mode == "full" else "INTO"
                    self.spark.sql(f"INSERT {verb} {self.table} BY NAME SELECT * FROM {view}")
                return stored.count()
            finally:
                self.spark.catalog.dropTempView(view)
