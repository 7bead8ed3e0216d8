"""Steps of a job: functions from branches to branches, chained into one lazy plan.

``Branches`` maps a table name to the rows meant for it; the default branch is the
job's own target.  A step acts on the default branch unless its configuration names
other tables, and leaves the remaining branches as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.functions.casts import cast_column
from rowtide.functions.predicates import condition, negated

DEFAULT_TABLE = ""

Branches = dict[str, DataFrame]


@dataclass(frozen=True)
class StepContext:
    """What a step may know besides its rows.

    ``table`` resolves ``(connection, table)`` to a frame, for lookups; it may also get
    the column and the keys that are wanted, and then read less.  ``stage`` stores a frame
    that several branches share, if the run is under way, in partitions of a column if one is named; ``rows`` is the number of source
    rows, if they were counted.
    """

    source_connection: str = ""
    source_table: str = ""
    target_connections: tuple[str, ...] = ()
    table: Callable[..., DataFrame] | None = None
    stage: Callable[..., DataFrame] | None = None
    source_schema: T.StructType | None = None
    unique_key: tuple[str, ...] = ()
    rows: int | None = None

    def lookup_table(
        self,
        connection: str,
        table: str,
        columns: Sequence[str] = (),
        key: str | None = None,
        keys: DataFrame | None = None,
        where: str | None = None,
        params: Mapping[str, Any] | None = None,
        limit: int | None = None,
        order: Sequence[str] = (),
    ) -> DataFrame:
        """Another table: at least its rows whose ``key`` occurs in the one column of ``keys``.

        ``where`` restricts them (SQL text, with ``params`` for its ``:names``); at most
        ``limit`` rows are taken of each ``key``, first in ``order``.
        """
        from rowtide.operators.lookup import restrict
        from rowtide.operators.ranking import first_n

        if self.table is None:
            raise ConfigError("this job has no lookup tables")
        if limit is not None and key is None:
            raise ConfigError(f"a limit on {table!r} needs the key it counts by")
        # A condition may name columns that nobody else asks for.
        read = () if where is not None or order else columns
        df = self.table(connection, table, columns=read, key=key, keys=keys)
        if where is not None:
            df = restrict(df, where, params)
        if limit is not None:
            df = first_n(df, [key], limit, order)
        return df.select(*[V.col(c) for c in columns]) if columns else df


Step = Callable[[StepContext, Branches], Branches]
StepFactory = Callable[[Any], Step]

_REGISTRY: dict[str, StepFactory] = {}


def register_step(name: str) -> Callable[[StepFactory], StepFactory]:
    """Decorator: make a step available to job documents under ``name``.

    The decorated function gets the step's ``config`` when the job is built, which is
    the time to refuse a bad one, and returns the step.
    """

    def add(factory: StepFactory) -> StepFactory:
        _REGISTRY[name] = factory
        return factory

    return add


def registered_steps() -> tuple[str, ...]:
    return tuple(sorted(_REGISTRY))


@dataclass(frozen=True)
class StepSpec:
    """One entry of a job's ``etl`` list."""

    name: str
    config: Any = None
    tables: tuple[str, ...] = ()

    @staticmethod
    def parse(raw: Any) -> StepSpec:
        """``{builtin|plugin: name, config}``, ``{name: config}`` or a bare name."""
        if isinstance(raw, str) and raw:
            return StepSpec(raw)
        if isinstance(raw, Mapping) and raw:
            tables = raw.get("tables") or ()
            tables = (tables,) if isinstance(tables, str) else tuple(tables)
            for key in ("plugin", "builtin"):
                if key in raw:
                    name = raw[key]
                    if not isinstance(name, str) or not name:
                        raise ConfigError(f"step: empty {key} name")
                    return StepSpec(name, raw.get("config"), tables)
            name = next(k for k in raw if k != "tables") if set(raw) != {"tables"} else None
            if isinstance(name, str) and name:
                return StepSpec(name, raw[name], tables)
        raise ConfigError(f"a step is {{builtin|plugin|name: ...}} or a name, got {raw!r}")

    def build(self) -> Step:
        if self.name not in _REGISTRY:
            raise ConfigError(f"unknown step {self.name!r}; known: {', '.join(registered_steps())}")
        step = _REGISTRY[self.name](self.config)
        return on_tables(step, self.tables) if self.tables else step


def on_tables(step: Step, tables: Sequence[str]) -> Step:
    """Run ``step`` on the named branches instead of the default one."""

    def run(ctx: StepContext, branches: Branches) -> Branches:
        out = dict(branches)
        for table in tables:
            if table not in branches:
                raise ConfigError(f"no branch {table!r} at this step; there is {sorted(branches)}")
            made = step(ctx, {DEFAULT_TABLE: out.pop(table)})
            renamed = {table if name == DEFAULT_TABLE else name: df for name, df in made.items()}
            out = merge_branches(out, renamed)
        return out

    return run


def merge_branches(a: Branches, b: Branches) -> Branches:
    """Rows of both, table by table; unlike columns are padded with nulls."""
    out = dict(a)
    for name, df in b.items():
        out[name] = out[name].unionByName(df, allowMissingColumns=True) if name in out else df
    return out


def chain(steps: Iterable[Step]) -> Step:
    """Steps one after another; none at all is the identity."""
    steps = list(steps)

    def run(ctx: StepContext, branches: Branches) -> Branches:
        for step in steps:
            branches = step(ctx, branches)
        return branches

    return run


def frame_step(fn: Callable[[DataFrame], DataFrame]) -> Step:
    """A step that only rewrites the default branch."""

    def run(ctx: StepContext, branches: Branches) -> Branches:
        if DEFAULT_TABLE not in branches:
            return branches
        return {**branches, DEFAULT_TABLE: fn(branches[DEFAULT_TABLE])}

    return run


def _items(config: Any, step: str) -> list[Mapping[str, Any]]:
    """The ``column`` list of a step's configuration; one mapping counts as a list."""
    if config is None:
        return []
    if not isinstance(config, Mapping):
        raise ConfigError(f"{step}: config must be a mapping")
    items = config.get("column") or []
    items = [items] if isinstance(items, Mapping) else list(items)
    for item in items:
        if not isinstance(item, Mapping):
            raise ConfigError(f"{step}: {item!r} is not a mapping")
    return items


def _need(item: Mapping[str, Any], key: str, step: str) -> str:
    if not isinstance(item.get(key), str):
        raise ConfigError(f"{step}: missing field {key!r} in {dict(item)!r}")
    return item[key]


# ---- rename ----------------------------------------------------------------


def rename(df: DataFrame, items: Iterable[tuple[str, str]]) -> DataFrame:
    """Rename in order.  A missing ``from`` is skipped, an existing ``to`` is replaced.

    Items are resolved to one final projection, so a long list adds one node to the plan.
    """
    origin = {name: name for name in df.columns}
    for old, new in items:
        if old not in origin:
            continue
        value = origin.pop(old)
        origin.pop(new, None)
        origin[new] = value
    return df.select(*[V.col(value).alias(name) for name, value in origin.items()])


@register_step("rename")
def _rename_step(config: Any) -> Step:
    items = [(_need(i, "from", "rename"), _need(i, "to", "rename")) for i in _items(config, "rename")]
    return frame_step(lambda df: rename(df, items))


# ---- set -------------------------------------------------------------------


def set_constants(df: DataFrame, constants: Mapping[str, Any]) -> DataFrame:
    """Add or overwrite columns by constants, plain or tagged.

    A null constant takes the type of the column it overwrites.
    """
    columns = {}
    for name, raw in constants.items():
        constant = raw if isinstance(raw, V.Constant) else V.parse_constant(raw, V.column_type(df, name))
        columns[name] = constant.column()
    return _with_columns(df, columns)


def _with_columns(df: DataFrame, columns: Mapping[str, Any]) -> DataFrame:
    """``withColumns`` by exact name (dots and case included)."""
    kept = [columns[n].alias(n) if n in columns else V.col(n) for n in df.columns]
    added = [c.alias(n) for n, c in columns.items() if n not in df.columns]
    return df.select(*kept, *added)


@register_step("set")
def _set_step(config: Any) -> Step:
    constants = (config or {}).get("constant") or {}
    if not isinstance(constants, Mapping):
        raise ConfigError("set: 'constant' must be a mapping")
    for raw in constants.values():
        V.parse_constant(raw)
    return frame_step(lambda df: set_constants(df, constants))


# ---- filter ----------------------------------------------------------------


def filter_rows(df: DataFrame, keep: str | None = None, drop: str | None = None) -> DataFrame:
    """Rows for which ``keep`` holds and ``drop`` does not."""
    if keep is not None:
        df = df.where(condition(keep, df))
    if drop is not None:
        df = df.where(negated(condition(drop, df)))
    return df


@register_step("filter")
def _filter_step(config: Any) -> Step:
    config = config or {}
    if not isinstance(config, Mapping):
        raise ConfigError("filter: config must be a mapping")
    keep, drop = config.get("keep"), config.get("drop")
    for text in (keep, drop):
        if text is not None and (not isinstance(text, str) or len(text.split()) != 3):
            raise ConfigError(f"filter: {text!r} is not '<column> <op> <value>'")
    return frame_step(lambda df: filter_rows(df, keep, drop))


# ---- cast ------------------------------------------------------------------


def cast_columns(df: DataFrame, items: Iterable[tuple[str, str]]) -> DataFrame:
    """Cast in order; a missing column is skipped, a repeated one is cast again."""
    columns: dict[str, Any] = {}
    for name, type_name in items:
        dtype = V.column_type(df, name)
        if dtype is None:
            continue
        if name in columns:
            df, columns = _with_columns(df, columns), {}
            dtype = V.column_type(df, name)
        columns[name] = cast_column(V.col(name), dtype, type_name)
    return _with_columns(df, columns) if columns else df


@register_step("cast")
def _cast_step(config: Any) -> Step:
    items = [(_need(i, "name", "cast"), _need(i, "type", "cast")) for i in _items(config, "cast")]
    return frame_step(lambda df: cast_columns(df, items))


# ---- provenance ------------------------------------------------------------


def with_provenance(df: DataFrame, ctx: StepContext) -> DataFrame:
    """Add where the rows came from, as constant columns."""
    return df.select(
        "*",
        F.lit(ctx.source_connection).alias("_source_connection"),
        F.lit(ctx.source_table).alias("_source_table"),
    )


@register_step("provenance")
def _provenance_step(config: Any) -> Step:
    def run(ctx: StepContext, branches: Branches) -> Branches:
        return {**branches, DEFAULT_TABLE: with_provenance(branches[DEFAULT_TABLE], ctx)}

    return run


# ---- user code, row by row -------------------------------------------------

TABLE_TAG = "_table"
# The partition column of rows that are stored for several tables.
PART = "_table_part"
# Output rows of user code held before they go back to Spark.
BATCH_ROWS = 10_000


@dataclass(frozen=True)
class _UserStep:
    """User code that turns rows into rows for any table; ``tables`` declares their columns.

    Rows are processed where they are, in Arrow batches: no shuffle, no grouping.
    """

    fn: Callable[..., Any]
    tables: Mapping[str, T.StructType] = field(default_factory=dict)

    def union_schema(self) -> T.StructType:
        fields: dict[str, T.StructField] = {}
        for table, schema in self.tables.items():
            for f in schema.fields:
                seen = fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
                if seen.dataType != f.dataType:
                    raise ConfigError(f"column {f.name!r} of {table!r} has two types")
        return T.StructType([T.StructField(TABLE_TAG, T.StringType(), False), *fields.values()])

    def tagged(self, df: DataFrame) -> DataFrame:
        """All output rows in one frame, with their table in ``_table``."""
        raise NotImplementedError

    def __call__(self, ctx: StepContext, branches: Branches) -> Branches:
        tagged, tag = self.tagged(branches[DEFAULT_TABLE]), F.col(TABLE_TAG)
        where = {table: tag == table for table in self.tables}
        if ctx.stage is not None and len(self.tables) > 1:
            # The code runs once; one write deals its rows into a partition for each table, and
            # every table reads its own.
            tagged = ctx.stage(tagged.withColumn(PART, F.concat(F.lit("of "), tag)), PART)
            where = {table: F.col(PART) == f"of {table}" for table in self.tables}
        rest = {k: v for k, v in branches.items() if k != DEFAULT_TABLE}
        made = {
            table: tagged.where(where[table]).select(*[V.col(n) for n in schema.names])
            for table, schema in self.tables.items()
        }
        return merge_branches(rest, made)


class RowStep(_UserStep):
    """``fn(row)`` gets a dict and yields ``(table, dict)`` pairs: none, one or several rows for any table."""

    def tagged(self, df: DataFrame) -> DataFrame:
        schema = self.union_schema()
        names = schema.names[1:]
        fn, known = self.fn, frozenset(self.tables)

        def run(batches):
            import pyarrow as pa
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            out: list[dict[str, Any]] = []
            for batch in batches:
                for row in batch.to_pylist():
                    for table, made in fn(row):
                        if table not in known:
                            raise ValueError(f"row step wrote to undeclared table {table!r}")
                        out.append({TABLE_TAG: table, **{n: made.get(n) for n in names}})
                    if len(out) >= BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out = []
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

        return df.mapInArrow(run, schema)


class BatchStep(_UserStep):
    """``fn(batch)`` gets an Arrow table of some rows and returns ``{table: Arrow table}``.

    Columns go to the declared types; those that a table does not have are null, undeclared
    ones are left out.  No row becomes a Python object unless ``fn`` makes it one.
    """

    def tagged(self, df: DataFrame) -> DataFrame:
        schema, fn, tables = self.union_schema(), self.fn, dict(self.tables)

        def run(batches):
            import pyarrow as pa
            from pyspark.sql.pandas.types import to_arrow_schema

            arrow = to_arrow_schema(schema)
            for batch in batches:
                if not batch.num_rows:
                    continue
                for table, made in fn(pa.Table.from_batches([batch])).items():
                    if table not in tables:
                        raise ValueError(f"batch step wrote to undeclared table {table!r}")
                    declared, there = tables[table].names, made.schema.names
                    columns = [pa.repeat(pa.scalar(table, pa.string()), made.num_rows)]
                    for f in list(arrow)[1:]:
                        known = f.name in declared and f.name in there
                        columns.append(made.column(f.name).cast(f.type) if known else pa.nulls(made.num_rows, f.type))
                    yield from pa.table(columns, schema=arrow).to_batches(BATCH_ROWS)

        return df.mapInArrow(run, schema)
