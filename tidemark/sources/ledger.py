"""The append-only run ledger: JSON events below ``year=``/``month=``."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.events import check_fields
from tidemark.schema import EVENT_SCHEMA
from tidemark.session import small_frame

logger = logging.getLogger(__name__)

_PARTITIONED = T.StructType(
    EVENT_SCHEMA.fields
    + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
)

_ARROW = pa.schema(
    [
        ("run_id", pa.string()),
        ("seq", pa.int64()),
        ("type", pa.string()),
        ("at", pa.timestamp("us")),
        ("data", pa.map_(pa.string(), pa.string())),
    ]
)


def is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def append(events: DataFrame, path: str) -> None:
    """Append events; each write is one batch of files, not one per event."""
    (
        events.select(*EVENT_SCHEMA.fieldNames())
        .withColumn("year", F.year("at"))
        .withColumn("month", F.month("at"))
        .write.mode("append")
        .partitionBy("year", "month")
        .json(path)
    )


def read(
    spark: SparkSession, path: str, months: list[tuple[int, int]] | None = None
) -> DataFrame:
    """Events of the given months; a line that is no event is passed over.

    No ledger yet means no events.  Any other failure is raised.
    """
    try:
        events = spark.read.schema(_PARTITIONED).json(path, mode="DROPMALFORMED")
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return small_frame(spark, [], _ARROW, EVENT_SCHEMA)
    if months is not None:
        wanted = F.lit(False)
        for year, month in months:
            wanted = wanted | ((F.col("year") == year) & (F.col("month") == month))
        events = events.filter(wanted)
    known = F.col("run_id").isNotNull() & F.col("seq").isNotNull()
    return events.filter(known).select(*EVENT_SCHEMA.fieldNames())


@dataclass
class RunLedger:
    """Writes one run's events in order; the run's own few events only."""

    spark: SparkSession
    path: str
    run_id: str
    now: object = field(default=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    seq: int = 0

    def append_rows(self, events: DataFrame) -> None:
        """Append events made where their data lies: ``seq`` from 1, ``type``, ``data``.

        Best effort, like :meth:`append`.
        """
        stamp = self.now().replace(microsecond=0)
        rows = events.select(
            F.lit(self.run_id).alias("run_id"),
            (F.col("seq") + self.seq).alias("seq"),
            "type",
            F.lit(stamp).cast("timestamp_ntz").alias("at"),
            "data",
        )
        try:
            append(rows, self.path)
        except Exception as error:  # noqa: BLE001
            logger.warning("ledger append failed: %s", type(error).__name__)

    def append(self, *events: tuple[str, dict], required: bool = False) -> None:
        """Append events.  A ledger that cannot be written must not stop a
        delivery, so failures are logged; ``required`` raises them instead,
        for the one event that readers take the master's version from."""
        rows = []
        for event_type, data in events:
            check_fields(event_type, list(data))
            self.seq += 1
            at = self.now().replace(microsecond=0)
            rows.append(
                {
                    "run_id": self.run_id,
                    "seq": self.seq,
                    "type": event_type,
                    "at": at,
                    "data": [(name, str(value)) for name, value in data.items()],
                }
            )
        try:
            made = small_frame(self.spark, rows, _ARROW, EVENT_SCHEMA)
            append(made.coalesce(1), self.path)
        except Exception as error:  # noqa: BLE001
            if required:
                raise
            logger.warning("ledger append failed: %s", type(error).__name__)
