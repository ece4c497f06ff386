"""Incremental diff over a landing folder.

The stream only discovers files; a micro-batch hands all that have come to the
batch job, so one gate verdict covers them all.  The query's checkpoint says
which files have been taken: a run that is blocked or fails raises, the
checkpoint stays where it is, and the next start hands over the same files
again.  The job names its output by content, so a replay adds nothing.
Nothing is ever late: a file counts as new whenever it arrives.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.jobs import run_incremental
from tidemark.plans.store import Store
from tidemark.schema import BLOCKED, FAILED, GATE_FRACTION
from tidemark.sources.extracts import Format
from tidemark.sources.files import literal_path


class LandingStopped(RuntimeError):
    """The run over a batch of files did not take them; they come again."""


def discovered(store: Store, landing: str) -> DataFrame:
    """Names of files as they arrive; contents are not read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return (
        store.spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .load(landing)
        .select("path", "length")
    )


def stream_landing(
    store: Store,
    landing: str,
    checkpoint: str,
    fmt: Format,
    as_of: dt.date,
    *,
    fraction: float | None = GATE_FRACTION,
) -> StreamingQuery:
    """Run the incremental job on the files that are new, then stop.

    Files without a byte count as sources that failed.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        # One name per file: what the reader of the batch is given in any case.
        paths = [literal_path(row["path"]) for row in batch.select("path").collect()]
        if not paths:
            return
        done = run_incremental(store, paths, fmt, as_of, fraction=fraction)
        if done.status in (BLOCKED, FAILED):
            raise LandingStopped(f"{done.run_id}: {done.status} at {done.step} ({done.error})")

    return (
        discovered(store, landing)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
