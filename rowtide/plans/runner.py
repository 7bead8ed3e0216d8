"""Running a job: read above the marks, map, apply the steps, write, then commit the marks."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError, TemplateError
from rowtide.operators.mapping import map_columns
from rowtide.operators.steps import DEFAULT_TABLE, Branches, StepContext, chain
from rowtide.operators.watermark import read_marks
from rowtide.plans.job import Job
from rowtide.plans.state import StateStore
from rowtide.plans.templates import Template
from rowtide.sinks.catalog import CatalogSink
from rowtide.sinks.jdbc import JdbcSink
from rowtide.sinks.paths import PathSink
from rowtide.sources import jdbc
from rowtide.sources.storage import Staging
from rowtide.sources.tables import Tables, scan


# Targets of one run that are written at the same time.
PARALLEL_TARGETS = 4


def session_now(spark: SparkSession) -> dt.datetime:
    """The present moment in the session's time zone."""
    text = spark.sql("SELECT date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss.SSSSSSxx')").first()[0]
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S.%f%z")


@dataclass
class RunResult:
    """What one run did."""

    job: str
    run_id: str
    rows_read: int
    rows_out: int
    written: Mapping[str, int]
    marks: Mapping[str, V.Constant]
    seconds: float

    def summary(self) -> str:
        lines = [f"{self.job} ({self.run_id}), {self.seconds:.1f} s", f"  source rows   {self.rows_read}", f"  after steps   {self.rows_out}"]
        return "\n".join([*lines, *[f"  into {t}   {n}" for t, n in sorted(self.written.items())]])


@dataclass
class Runner:
    """Runs jobs against named connections; marks are kept under ``state_root``."""

    spark: SparkSession
    connections: Tables
    state_root: str
    retry: int = 3
    fetch: int = jdbc.FETCH_ROWS
    views: Mapping[str, DataFrame] = field(default_factory=dict)

    def store(self, job: Job) -> StateStore:
        return StateStore(self.spark, self.state_root, job.name)

    def reset_state(self, job: Job) -> None:
        """Make the next run a first run."""
        self.store(job).reset()

    # ---- planning: no rows move -------------------------------------------

    def template(
        self,
        job: Job,
        now: dt.datetime,
        marks: Mapping[str, V.Constant],
        schema: T.StructType | None = None,
    ) -> Template:
        types = _LazySchema(self, job, schema)

        def state(key: str) -> V.Constant:
            if key in marks:
                return self._as_read(job, marks[key])
            if key not in job.state:
                raise TemplateError(f"state key {key!r} is not declared under sync.state")
            return types.lower_bound(job.state[key].column)

        return Template(state, now)

    def _as_read(self, job: Job, mark: V.Constant) -> V.Constant:
        """A mark in the terms of the source: a database compares with the session's local time."""
        moment = mark.value
        if not isinstance(moment, dt.datetime) or moment.tzinfo is None or not self.connections.connection(job.source.connection).is_database:
            return mark
        local = self.spark.range(1).select(F.lit(mark.text()).cast("timestamp").cast("string")).first()[0]
        return V.Constant(dt.datetime.fromisoformat(local), mark.dtype)

    def read(self, job: Job, now: dt.datetime, marks: Mapping[str, V.Constant]) -> DataFrame:
        """The source rows of one run."""
        src = job.source
        conn = self.connections.connection(src.connection)
        fetch = src.batch_limit or self.fetch
        if conn.is_database:
            template = self.template(job, now, marks)
            slices = self._slices(job)
            if src.select:
                return jdbc.read_sql(self.spark, conn, template.render(src.select, conn.type), slices, fetch)
            where = template.render(src.where, conn.type) if src.where else None
            columns = _read_columns(job)
            return self.connections.read(src.connection, src.table, columns, where, slices, fetch)
        if src.select:
            bound = self.template(job, now, marks).bind(src.select)
            return self.connections.select(src.connection, bound.sql, bound.args)
        df = self.connections.read(src.connection, src.table)
        if src.where:
            bound = self.template(job, now, marks, df.schema).bind(src.where)
            df = scan(df, (), bound.sql, bound.args)
        return scan(df, [c for c in _read_columns(job) if c in df.columns])

    def _slices(self, job: Job) -> jdbc.Slices | None:
        src = job.source
        conn = self.connections.connection(src.connection)
        count = src.partitions or conn.max_pool_size
        schema = _LazySchema(self, job)
        if src.partition_column:
            # Text has no widths to cut.
            depth = src.partition_by == "depth" or not jdbc.can_slice(schema.type_of(src.partition_column))
            return jdbc.Slices(src.partition_column, count, depth=depth)
        for column in (*src.primary_key, *job.tracked().values()):
            if jdbc.can_slice(schema.type_of(column)):
                return jdbc.Slices(column, count)
        if src.table and not src.select:
            return jdbc.key_slices(self.spark, conn, src.table, _read_columns(job))
        return None

    def plan(
        self,
        job: Job,
        df: DataFrame,
        stage: Callable[[DataFrame], DataFrame] | None = None,
        rows: int | None = None,
    ) -> Branches:
        """The lazy frames of every target table.

        ``stage`` is there during a run; without it nothing is written.  ``rows`` is the
        number of source rows, if they were counted.
        """
        renamed = dict(zip(job.source.columns, job.target.columns, strict=False))
        ctx = StepContext(
            source_connection=job.source.connection,
            source_table=job.source.label,
            target_connections=(job.target.connection,),
            table=self.connections.read,
            stage=stage,
            rows=rows,
            source_schema=df.schema,
            unique_key=tuple(renamed.get(k, k) for k in job.source.primary_key),
        )
        mapped = map_columns(df, job.source.columns, job.target.columns, job.null_type)
        branches = chain([s.build() for s in job.etl])(ctx, {DEFAULT_TABLE: mapped})
        named = {job.target.table if t == DEFAULT_TABLE else t: f for t, f in branches.items()}
        if job.mode == "upsert":
            keyless = [t for t in named if not job.target.keys_of(t)]
            if keyless:
                raise ConfigError(f"job {job.name!r}: upsert needs keys for {keyless} (target.keys)")
        return named

    # ---- execution ---------------------------------------------------------

    def run(self, job: Job, now: dt.datetime | None = None, run_id: str | None = None) -> RunResult:
        """One pass.  The marks move only after every target is written."""
        started = time.monotonic()
        now = now or session_now(self.spark)
        run_id = run_id or f"{now:%Y%m%d%H%M%S}{uuid.uuid4().hex[:8]}"
        store = self.store(job)
        df = self.read(job, now, store.load())
        with Staging(self.spark, run_id) as stage:
            # Stored once: the count, the marks and every target come from the same rows, also
            # when the source changes meanwhile or its select is not repeatable.
            df = stage(df)
            rows_read, marks = read_marks(df, job.tracked())
            if not rows_read and job.mode != "full":
                # Nothing new: no target is touched, and no other table read.
                seconds = time.monotonic() - started
                return RunResult(job.name, run_id, 0, 0, {job.target.table: 0}, store.load(), seconds)
            branches = self.plan(job, df, stage, rows_read)
            # Several rows of one key are one written row, but each is a row of the steps: counted
            # in passing, by the pass that writes.
            seen = {table: Observation() for table in branches} if job.mode == "upsert" else {}
            watched = {t: f.observe(seen[t], F.count(F.lit(1)).alias("rows")) if seen else f for t, f in branches.items()}
            written = self.write(job, watched, run_id)
            rows_out = sum(o.get["rows"] for o in seen.values()) if seen else sum(written.values())
            kept = store.commit(marks, run_id) if job.state else {}
        seconds = time.monotonic() - started
        return RunResult(job.name, run_id, rows_read, rows_out, written, kept, seconds)

    def write(self, job: Job, branches: Branches, run_id: str) -> dict[str, int]:
        """Write every branch to its table, side by side; rows written per table."""

        def one(table: str) -> int:
            df = branches[table]
            return self.sink(job, table, df.columns).write(df, job.mode, run_id)

        if len(branches) == 1:
            return {table: one(table) for table in branches}
        with ThreadPoolExecutor(PARALLEL_TARGETS) as pool:
            return dict(zip(branches, pool.map(one, branches), strict=True))

    def sink(self, job: Job, table: str, columns: Sequence[str]) -> PathSink | JdbcSink | CatalogSink:
        conn = self.connections.connection(job.target.connection)
        keys, order = job.target.keys_of(table), job.order_of(table, columns)
        if conn.is_database:
            return JdbcSink(self.spark, conn, table, keys, order, job.writers, retry=self.retry)
        if conn.type == "catalog":
            return CatalogSink(self.spark, conn.table_name(table), keys, order)
        return PathSink(self.spark, self.connections.path(conn, table), keys, order)


def _read_columns(job: Job) -> list[str]:
    """Listed columns plus the tracked ones; nothing listed means all."""
    if not job.source.columns:
        return []
    return list(dict.fromkeys([*job.source.columns, *[s.column for s in job.state.values()]]))


@dataclass
class _LazySchema:
    """The source's column types, looked up only when a first run needs them."""

    runner: Runner
    job: Job
    known: T.StructType | None = None

    def lower_bound(self, column: str) -> V.Constant:
        return V.lower_bound(self.type_of(column))

    def type_of(self, column: str) -> T.DataType | None:
        src, tables = self.job.source, self.runner.connections
        if self.known is not None:
            schema = self.known
        elif src.table and not src.select:
            schema = tables.read(src.connection, src.table).schema
        else:
            schema = self._probe()
        return next((f.dataType for f in schema.fields if f.name == column), None)

    def _probe(self) -> T.StructType:
        """Schema of a custom select, by analysis only; marks count as null meanwhile."""
        src, tables = self.job.source, self.runner.connections
        template = Template(lambda key: V.Constant(None, T.NullType()), dt.datetime(1970, 1, 1))
        if tables.connection(src.connection).is_database:
            return tables.select(src.connection, template.render(src.select, tables.connection(src.connection).type)).schema
        bound = template.bind(src.select)
        return tables.select(src.connection, bound.sql, bound.args).schema
