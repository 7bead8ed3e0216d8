"""Job documents: one declarative description per synchronisation."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from rowtide.errors import ConfigError
from rowtide.operators.steps import StepSpec

MODES = ("full", "upsert", "append")


def names(raw: Any) -> tuple[str, ...]:
    """Column names, as a list or as comma-separated text; blanks are dropped."""
    if raw is None:
        return ()
    parts = raw.split(",") if isinstance(raw, str) else raw
    if not isinstance(parts, Sequence):
        raise ConfigError(f"expected column names, got {raw!r}")
    return tuple(p for p in (str(part).strip() for part in parts) if p)


def parse_mode(text: str) -> str:
    mode = str(text).lower()
    if mode not in MODES:
        raise ConfigError(f"unknown sync mode {text!r}")
    return mode


def _one_of(value: object, known: tuple[str, ...], where: str) -> str:
    if value not in known:
        raise ConfigError(f"{where}: one of {', '.join(known)} is needed, not {value!r}")
    return str(value)


@dataclass(frozen=True)
class Source:
    """Where rows come from: a ``table`` (with ``columns`` and ``where``), or a ``select``.

    ``partition_column`` and ``partitions`` say how a database read is cut; the default
    is the single key column, and the connection's pool size.  ``partition_by: depth`` cuts
    slices of equally many rows, as text columns always get; else they are equally wide.
    """

    connection: str
    table: str = ""
    columns: tuple[str, ...] = ()
    where: str | None = None
    primary_key: tuple[str, ...] = ()
    batch_limit: int | None = None
    select: str | None = None
    partition_column: str | None = None
    partitions: int | None = None
    partition_by: str = "width"

    @property
    def label(self) -> str:
        return self.table or "<custom-select>"


@dataclass(frozen=True)
class Target:
    connection: str
    table: str
    columns: tuple[str, ...] = ()
    primary_key: tuple[str, ...] = ()
    # Keys of further tables that steps write to.
    keys: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def keys_of(self, table: str) -> tuple[str, ...]:
        return self.primary_key if table == self.table else tuple(self.keys.get(table, ()))


@dataclass(frozen=True)
class StateSpec:
    """A mark: the ``max`` of a source column."""

    column: str
    kind: str = "max"


@dataclass(frozen=True)
class Job:
    name: str
    source: Source
    target: Target
    mode: str = "upsert"
    state: Mapping[str, StateSpec] = field(default_factory=dict)
    etl: tuple[StepSpec, ...] = ()
    order_by: tuple[str, ...] = ()
    enabled: bool = True
    description: str = ""
    writers: int = 1
    # When to run: a trigger interval for the streaming runner, kept as text.
    schedule: str = ""
    null_type: str = "string"

    def tracked(self) -> dict[str, str]:
        """Mark names and the source columns they follow."""
        return {key: spec.column for key, spec in self.state.items()}

    def order_of(self, table: str, columns: Sequence[str]) -> tuple[str, ...]:
        """What says which of several rows of a key is the last: the declared order, or
        the tracked columns under their target names."""
        if table != self.target.table:
            return ()
        if self.order_by:
            return self.order_by
        renamed = dict(zip(self.source.columns, self.target.columns, strict=False))
        order = (renamed.get(c, c) for c in self.tracked().values())
        return tuple(c for c in order if c in columns and c not in self.target.primary_key)

    @staticmethod
    def from_dict(doc: Mapping[str, Any]) -> Job:
        """A job from its document; what is missing or contradictory is refused here."""
        if not isinstance(doc, Mapping) or not isinstance(doc.get("name"), str):
            raise ConfigError("a job needs a name")
        name = doc["name"]
        source, target = _source(name, doc.get("source")), _target(name, doc.get("target"))
        sync = doc.get("sync") or {}
        raw_etl = doc.get("etl") or []
        # One step may stand alone.
        steps = raw_etl if isinstance(raw_etl, (list, tuple)) else [raw_etl]
        job = Job(
            name=name,
            source=source,
            target=target,
            mode=parse_mode(sync.get("mode", "upsert")),
            state=_state(name, sync.get("state")),
            etl=tuple(StepSpec.parse(s) for s in steps),
            order_by=names(sync.get("order_by")),
            enabled=bool(doc.get("enabled", True)),
            description=str(doc.get("description") or ""),
            writers=max(1, int(doc.get("writers") or 1)),
            schedule=str((doc.get("schedule") or {}).get("every") or ""),
            null_type=str(doc.get("null_type") or "string"),
        )
        for step in job.etl:
            step.build()
        if (doc.get("schedule") or {}).get("cron"):
            # An external clock starts such a job; ``every`` is what a trigger can take.
            warnings.warn(f"job {name!r}: schedule.cron is not acted on here", stacklevel=2)
        if source.select and source.where:
            warnings.warn(f"job {name!r}: source.select is there, so source.where is not used", stacklevel=2)
        if job.mode == "upsert" and not target.primary_key:
            raise ConfigError(f"job {name!r}: upsert needs target.primary_key")
        return job

    @staticmethod
    def from_yaml(text: str) -> Job:
        import yaml

        try:
            doc = yaml.safe_load(text)
        except yaml.YAMLError as e:
            raise ConfigError(f"invalid yaml: {e}") from e
        return Job.from_dict(doc)


def _source(job: str, raw: Any) -> Source:
    if not isinstance(raw, Mapping) or not isinstance(raw.get("connection"), str):
        raise ConfigError(f"job {job!r}: source.connection is missing")
    table, select = str(raw.get("table") or ""), raw.get("select")
    if select is not None and not str(select).strip():
        select = None
    if not table and select is None:
        raise ConfigError(f"job {job!r}: say what to read: source.table, or source.select with some text")
    where = raw.get("where")
    limit = raw.get("batch_limit")
    return Source(
        connection=raw["connection"],
        table=table,
        columns=names(raw.get("columns")),
        where=str(where).strip() or None if where is not None else None,
        primary_key=names(raw.get("primary_key")),
        batch_limit=limit if isinstance(limit, int) and limit > 0 else None,
        select=str(select) if select is not None else None,
        partition_column=raw.get("partition_column"),
        partitions=raw.get("partitions"),
        partition_by=_one_of(raw.get("partition_by") or "width", ("width", "depth"), "source.partition_by"),
    )


def _target(job: str, raw: Any) -> Target:
    if not isinstance(raw, Mapping) or not isinstance(raw.get("connection"), str):
        raise ConfigError(f"job {job!r}: target.connection is missing")
    if not isinstance(raw.get("table"), str) or not raw["table"]:
        raise ConfigError(f"job {job!r}: target.table is missing")
    return Target(
        connection=raw["connection"],
        table=raw["table"],
        columns=names(raw.get("columns")),
        primary_key=names(raw.get("primary_key")),
        keys={str(t): names(k) for t, k in (raw.get("keys") or {}).items()},
    )


def _state(job: str, raw: Any) -> dict[str, StateSpec]:
    out = {}
    for key, spec in (raw or {}).items():
        spec = spec or {}
        kind, column = str(spec.get("type", "max")), str(spec.get("column") or "")
        if kind != "max":
            raise ConfigError(f"job {job!r}: state {key!r} has unsupported type {kind!r} (only 'max')")
        if not column:
            raise ConfigError(f"job {job!r}: state {key!r} has no column")
        out[str(key)] = StateSpec(column, kind)
    return out
