"""The same job over a stream: every micro-batch is one run of it.

A stream's own checkpoint says what was read, so no marks are needed; a micro-batch
that is repeated after a failure has the same id.  Full writes, upserts, and appends into
folders and databases then take effect once; appends into catalogue tables are repeated.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.operators.watermark import read_marks
from rowtide.plans.job import Job
from rowtide.plans.runner import Runner, RunResult
from rowtide.sources.storage import Staging, Storage


_EVENT_TIME = "__event_time"


@dataclass(frozen=True)
class Lateness:
    """How late a row may come behind the newest one, by its ``column``; beyond it rows are dropped.

    Rows that repeat a key inside the bound, in whatever micro-batch, count once: keys are kept
    as state for as long as a repetition may come, and no longer.
    """

    column: str
    bound: str
    keys: tuple[str, ...] = ()

    def once(self, stream: DataFrame, keys: Sequence[str]) -> DataFrame:
        by = list(self.keys or keys)
        if not by:
            raise ConfigError("rows that may come late need a key to be told apart")
        # Watermarks follow instants; local times are read in the session's zone.
        timed = stream.withColumn(_EVENT_TIME, V.col(self.column).cast("timestamp"))
        return timed.withWatermark(_EVENT_TIME, self.bound).dropDuplicatesWithinWatermark(by).drop(_EVENT_TIME)


def start(
    runner: Runner, job: Job, stream: DataFrame, checkpoint: str, every: str | None = None, late: Lateness | None = None
) -> StreamingQuery:
    """Write ``stream`` to the job's targets, batch by batch.

    ``every`` is a processing-time interval; without it everything available is taken
    and the query ends, which suits an external clock.  With ``late`` each key of the source
    passes once, also if it comes again in a later batch.
    """
    if job.mode == "full":
        raise ConfigError("full mode replaces the target; it has no meaning for a stream")
    if late is not None:
        stream = late.once(stream, job.source.primary_key)

    def one(batch: DataFrame, batch_id: int) -> None:
        # Batch numbers start anew with every checkpoint, so its own id goes along.
        query = json.loads(Storage(runner.spark).read_text(f"{checkpoint}/metadata"))["id"]
        run_id = f"{query}-{batch_id:012d}"
        with Staging(runner.spark, run_id) as stage:
            batch = stage(batch)
            rows, marks = read_marks(batch, job.tracked())
            runner.write(job, runner.plan(job, batch, stage, rows), run_id)
            if job.state:
                runner.store(job).commit(marks, run_id)

    writer = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def poll(
    runner: Runner,
    job: Job,
    checkpoint: str,
    every: str,
    done: Callable[[RunResult], None] | None = None,
) -> StreamingQuery:
    """Run the job again and again, for sources that are no streams.

    Every trigger is one :meth:`Runner.run`, which reads above the stored marks.  Runs do
    not overlap: a late one delays the next.  ``done`` gets each result.
    """

    def tick(_: DataFrame, __: int) -> None:
        result = runner.run(job)
        if done is not None:
            done(result)

    clock = runner.spark.readStream.format("rate").load()
    writer = clock.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()
