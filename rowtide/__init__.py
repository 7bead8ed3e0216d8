"""rowtide: table synchronisation and row-level ETL as lazy Spark plans."""

from rowtide.operators import lookup as _lookup, split as _split  # noqa: F401  they register their steps
from rowtide.operators.steps import BatchStep, RowStep, StepContext, register_step
from rowtide.plans.config import load_app
from rowtide.plans.job import Job
from rowtide.plans.runner import Runner, RunResult
from rowtide.sources.connections import Connection, load_connections
from rowtide.sources.tables import Tables

__all__ = [
    "Connection",
    "Job",
    "BatchStep",
    "RowStep",
    "RunResult",
    "Runner",
    "StepContext",
    "Tables",
    "load_app",
    "load_connections",
    "register_step",
]
