"""The main document: where connections, jobs and state are, and how jobs run."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any

import yaml
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowtide.errors import ConfigError
from rowtide.plans.job import Job
from rowtide.plans.runner import Runner, RunResult
from rowtide.plans.state import safe_name
from rowtide.sources.connections import load_connections
from rowtide.sources.storage import Storage
from rowtide.sources.tables import Tables


@dataclass
class App:
    """All enabled jobs of a main document, and the runner for them."""

    runner: Runner
    jobs: tuple[Job, ...]
    workers: int = 4

    def run_once(self) -> dict[str, RunResult | Exception]:
        """Run every job, ``workers`` at a time; one that fails does not stop the others."""

        def one(job: Job) -> RunResult | Exception:
            try:
                return self.runner.run(job)
            except Exception as e:
                return e

        with ThreadPoolExecutor(self.workers) as pool:
            return dict(zip((j.name for j in self.jobs), pool.map(one, self.jobs), strict=True))


    def poll(self, checkpoints: str, done: Callable[[RunResult], None] | None = None) -> list[StreamingQuery]:
        """Run every job with ``schedule.every`` again and again, at its interval; the queries, which can be stopped.

        Runs of one job do not overlap; each keeps its clock's checkpoint in a folder of its own.
        """
        from rowtide.streaming import microbatch

        timed = [j for j in self.jobs if j.schedule]
        return [microbatch.poll(self.runner, j, f"{checkpoints.rstrip('/')}/{safe_name(j.name)}", j.schedule, done) for j in timed]


def _document(storage: Storage, path: str) -> Mapping[str, Any]:
    try:
        doc = yaml.safe_load(storage.read_text(path))
    except yaml.YAMLError as e:
        raise ConfigError(f"invalid yaml in {path}: {e}") from e
    if not isinstance(doc, Mapping):
        raise ConfigError(f"{path} is not a mapping")
    return doc


def load_app(spark: SparkSession, path: str) -> App:
    """Read a main document; relative paths in it start from its own folder."""
    storage, base = Storage(spark), os.path.dirname(path)

    def at(name: str) -> str:
        return name if name.startswith("/") or "://" in name else os.path.join(base, name)

    doc = _document(storage, path)
    runtime = doc.get("runtime") or {}
    connections = load_connections(_document(storage, at(doc.get("datasource_file") or "datasource.yaml")))
    jobs = [Job.from_dict(_document(storage, at(j))) for j in doc.get("jobs") or []]
    seen = [j.name for j in jobs]
    if len(set(seen)) != len(seen):
        raise ConfigError(f"two jobs have the same name: {sorted(seen)}")
    runner = Runner(
        spark,
        Tables(spark, connections),
        at(doc.get("state_dir") or "state"),
        retry=int(runtime.get("retry", 3)),
        fetch=max(1, int(runtime.get("page_size") or 10_000)),
    )
    return App(runner, tuple(j for j in jobs if j.enabled), max(1, int(runtime.get("workers") or 4)))
