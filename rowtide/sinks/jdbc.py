"""Targets in a database: rows are staged by parallel tasks, then merged by one statement.

The staging table belongs to one run, so a run that is repeated starts clean; the
target changes in one transaction.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.errors import ConfigError
from rowtide.operators.ranking import upsert_rows
from rowtide.operators.routing import route
from rowtide.sources import dialects, jdbc
from rowtide.sources.connections import Connection
from rowtide.sources.storage import Staging

BATCH_ROWS = 500
ROW_ID = "rt_row_id"

R = TypeVar("R")


def with_retry(action: Callable[[], R], retry: int, sleep: Callable[[float], None] = time.sleep) -> R:
    """``action``, tried up to ``retry`` more times after 1, 2, 4 ... seconds."""
    for attempt in range(retry + 1):
        try:
            return action()
        except Exception:
            if attempt == retry:
                raise
            sleep(float(2**attempt))
    raise AssertionError("unreachable")


@dataclass
class JdbcSink:
    """One target table; ``writers`` is the least number of parallel database connections; the
    connection's pool size may raise it."""

    spark: SparkSession
    connection: Connection
    table: str
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    writers: int = 1
    batch: int = BATCH_ROWS
    retry: int = 3

    def write(self, df: DataFrame, mode: str, run_id: str) -> int:
        if mode not in ("full", "append", "upsert"):
            raise ConfigError(f"unknown sync mode {mode!r}")
        if mode == "upsert" and not self.keys:
            raise ConfigError(f"upsert into {self.table!r} needs key columns")
        if mode == "upsert":
            df = upsert_rows(df, self.keys, self.order)
        # Stored first: a task that is repeated then sends the same rows in the same order,
        # so that their numbers tell which of them a lost task had sent already.
        with Staging(self.spark, run_id) as stage:
            return self._write(stage(df), mode, run_id)

    def _write(self, df: DataFrame, mode: str, run_id: str) -> int:
        columns = df.columns
        # Repeated runs find their own staging table again; parallel targets have different ones.
        stage = f"rt_stage_{zlib.crc32(run_id.encode()):08x}_{zlib.crc32(self.table.encode()):08x}"
        if mode == "append" and (done := with_retry(lambda: self._done(run_id), self.retry)) >= 0:
            return done

        def filled() -> None:
            # A new attempt begins with an empty table.
            self._create_stage(stage, columns)
            self._fill(df.withColumn(ROW_ID, F.monotonically_increasing_id()), stage)

        try:
            with_retry(filled, self.retry)
            return self._apply(stage, columns, mode, run_id)
        finally:
            self._drop(stage)

    def _done(self, run_id: str) -> int:
        """Rows of this append, if it took effect already; -1 if not."""
        with jdbc.session(self.spark, self.connection) as handle:
            if not jdbc.has_table(handle, self.connection.schema, dialects.RUNS):
                jdbc.execute(handle, dialects.runs_table_sql(self.connection.type))
            return jdbc.scalar(handle, dialects.run_sql(self.connection.type, self.table, run_id))

    def _create_stage(self, stage: str, columns: list[str]) -> None:
        self._drop(stage)
        with jdbc.session(self.spark, self.connection) as handle:
            sql = dialects.staging_sql(self.connection.type, stage, self.table, columns, ROW_ID)
            jdbc.execute(handle, sql)

    def _drop(self, stage: str) -> None:
        with jdbc.session(self.spark, self.connection) as handle:
            if jdbc.has_table(handle, self.connection.schema, stage):
                jdbc.execute(handle, f"DROP TABLE {dialects.quote(self.connection.type, stage)}")

    def _fill(self, df: DataFrame, stage: str) -> None:
        # Reading and computing keep their own parallelism; only the writers are limited.
        writers = max(self.writers, self.connection.max_pool_size)
        # Staged rows need no order: dealt evenly, whatever their keys.
        routed = route(df, writers)
        (
            routed.write.format("jdbc")
            .options(**self.connection.jdbc_options())
            .option("numPartitions", writers)
            .option("batchsize", self.batch)
            .option("dbtable", dialects.table_name(self.connection, stage))
            .mode("append")
            .save()
        )

    def _apply(self, stage: str, columns: list[str], mode: str, run_id: str) -> int:
        dialect, table = self.connection.type, self.table
        change = [dialects.insert_sql(dialect, table, stage, columns, ROW_ID)]
        if mode == "upsert":
            change = [dialects.upsert_sql(dialect, table, stage, columns, self.keys, ROW_ID)]
        if mode == "full":
            # Emptied even when nothing arrives.
            change.insert(0, dialects.empty_sql(dialect, table))
        # The staged rows go in the same transaction: if its answer gets lost, the next
        # attempt finds them gone and knows that it succeeded.
        change.append(dialects.delete_sql(dialect, stage))
        counted = dialects.count_sql(dialect, stage, ROW_ID)
        first: list[int] = []

        def run() -> int:
            with jdbc.session(self.spark, self.connection) as handle:
                first.append(jdbc.scalar(handle, counted))
                if first[-1] or not first[0]:
                    # An append leaves its run beside the target, in one transaction: repeated, it is known.
                    run_row = [dialects.run_done_sql(dialect, table, run_id, first[0])] if mode == "append" else []
                    if not run_row or jdbc.scalar(handle, dialects.run_sql(dialect, table, run_id)) < 0:
                        jdbc.transaction(handle, [*change, *run_row])
                return first[0]

        return with_retry(run, self.retry)
