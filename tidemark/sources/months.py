"""The ledger folded by month: closed months as Parquet, the open tail as JSON.

Events are appended as JSON to the month they are written in.  A month that is
over gets no more of them, so it can be folded: its events are written once as
Parquet, sorted by type, and one line of an index says how many runs started in
it and which version of the master was committed at its end.  The JSON stays
where it is and is no longer read.

Whoever asks for the newest runs reads the tail and as many folded months, newest
first, as the index shows to be needed; whoever asks for the master's version
begins with the one the index names.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.schema import EVENT_SCHEMA
from tidemark.session import small_frame, stage
from tidemark.sources import ledger
from tidemark.sources.master import Version, committed

_INDEX = "month int, started long, records long, digest string, segments array<string>"
_ARROW = pa.schema(
    [
        ("month", pa.int32()),
        ("started", pa.int64()),
        ("records", pa.int64()),
        ("digest", pa.string()),
        ("segments", pa.list_(pa.string())),
    ]
)
_EVENTS = T.StructType(
    EVENT_SCHEMA.fields
    + [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
)


@dataclass(frozen=True)
class Month:
    """A folded month, counted from the year 0, its runs, and the version at its end."""

    number: int
    started: int
    version: Version


def number_of(year, month):
    return year * 12 + month - 1


def _folded(path: str) -> str:
    return f"{path}_folded/events"


def _index(path: str) -> str:
    return f"{path}_folded/index"


def index(spark: SparkSession, path: str) -> list[Month]:
    """The folded months, oldest first; one row a month."""
    try:
        rows = spark.read.schema(_INDEX).json(_index(path)).collect()
    except AnalysisException as error:
        if not ledger.is_missing(error):
            raise
        return []
    # A month folded twice says the same twice.
    found = {
        row["month"]: Month(
            row["month"],
            row["started"],
            Version(row["records"], int(row["digest"]), tuple(row["segments"])),
        )
        for row in rows
    }
    return [found[number] for number in sorted(found)]


def _number() -> Column:
    return number_of(F.col("year"), F.col("month"))


def _tail(spark: SparkSession, path: str, after: int | None, before: int | None = None) -> DataFrame | None:
    """JSON events of the months after one and before another, with year and month."""
    try:
        events = spark.read.schema(_EVENTS).json(path, mode="DROPMALFORMED")
    except AnalysisException as error:
        if not ledger.is_missing(error):
            raise
        return None
    if after is not None:
        events = events.where(_number() > after)
    if before is not None:
        events = events.where(_number() < before)
    return events.where(F.col("run_id").isNotNull() & F.col("seq").isNotNull())


def read(
    spark: SparkSession, path: str, since: int | None = None, folded: list[Month] | None = None
) -> DataFrame:
    """Events of all months, or of the month numbered ``since`` and later ones."""
    folded = index(spark, path) if folded is None else folded
    last = folded[-1].number if folded else None
    bounds = [number for number in (last, since - 1 if since is not None else None) if number is not None]
    tail = _tail(spark, path, max(bounds, default=None))
    parts = [] if tail is None else [tail]
    if folded and (since is None or since <= last):
        closed = spark.read.schema(_EVENTS).parquet(_folded(path))
        closed = closed.where(_number() <= last)
        parts.append(closed if since is None else closed.where(_number() >= since))
    if not parts:
        return ledger.read(spark, path)
    names = EVENT_SCHEMA.fieldNames()
    events = parts[0].select(*names)
    return events.unionByName(parts[1].select(*names)) if len(parts) > 1 else events


def version(spark: SparkSession, path: str) -> Version:
    """The committed version: the newest folded month's and the commits since."""
    folded = index(spark, path)
    if not folded:
        return committed(ledger.read(spark, path))
    since = read(spark, path, folded[-1].number + 1, folded)
    return committed(since, folded[-1].version)


def fold(spark: SparkSession, path: str, today: dt.date) -> list[int]:
    """Fold the months before the last one that are not folded yet; their numbers.

    The last month is left open as well as the present one, so a run that began
    before midnight has long ended.  All months are written in one job, then one
    line each is added to the index: a fold that stopped is simply done again.
    """
    folded = index(spark, path)
    last = folded[-1].number if folded else None
    events = _tail(spark, path, last, number_of(today.year, today.month) - 1)
    if events is None:
        return []
    first = (F.col("seq") == 1).cast("long")
    counted = events.groupBy(_number().alias("number")).agg(F.sum(first).alias("started"))
    started = {row["number"]: row["started"] for row in counted.collect()}  # one row a month
    if not started:
        return []
    order = ["year", "month", "type", "run_id", "seq"]
    (
        events.repartitionByRange(*order).sortWithinPartitions(*order)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month").parquet(_folded(path))
    )
    closed = spark.read.schema(_EVENTS).parquet(_folded(path))
    commits = stage(closed.where((F.col("type") == "MasterCommitted")), "commits")
    with_commits = {row["n"] for row in commits.select(_number().alias("n")).distinct().collect()}
    rows, now = [], folded[-1].version if folded else Version()
    for number in sorted(started):
        if number in with_commits:
            now = committed(commits.where(_number() == number), now)
        rows.append(
            {
                "month": number,
                "started": started[number],
                "records": now.records,
                "digest": str(now.digest),
                "segments": list(now.segments),
            }
        )
    schema = spark.createDataFrame([], _INDEX).schema
    small_frame(spark, rows, _ARROW, schema).coalesce(1).write.mode("append").json(_index(path))
    return sorted(started)


def recent(spark: SparkSession, path: str, runs: int) -> DataFrame:
    """All events of the ``runs`` runs started last, from the months that are needed.

    A run starts with its event 1.  Once the months read hold enough of these, no
    earlier one can matter: a run that started before them is older than all.
    """
    folded = index(spark, path)
    last = folded[-1].number if folded else None
    tail = _tail(spark, path, last)
    found = 0 if tail is None or not folded else tail.where(F.col("seq") == 1).count()
    since = None if last is None else last + 1
    for month in reversed(folded):
        if found >= runs:
            break
        found, since = found + month.started, month.number
    events = read(spark, path, since if found >= runs else None, folded)
    newest = events.where(F.col("seq") == 1).orderBy(F.desc("at"), "run_id").limit(runs)
    newest = stage(newest.select("run_id"), "newest")  # ``runs`` rows
    return events.join(F.broadcast(newest), "run_id", "left_semi").select(*EVENT_SCHEMA.fieldNames())
