"""An incremental run of many districts in one plan.

One landing is read for all districts.  What each of them knows, sent and may
deliver are columns of one row per district: metrics, gate, decision, events.
No row of a district passes through the driver, and the number of Spark jobs
does not depend on how many districts there are.

Order: archive, gate, deliver, commit, as for one district.  Delivery and commit
are restricted to the districts that pass by a semi-join.  The master is one
table of content-named segments, a folder per district inside; a district's
commit event names the segment that holds its new records, and readers see what
is committed and nothing else.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.digest import digest_sum, record_line
from tidemark.functions.events import payload
from tidemark.functions.names import diff_name, new_run_id
from tidemark.operators import coverage, gate, numbering, records, runs, sources
from tidemark.plans.store import utc_now
from tidemark.schema import (
    ACTION_COMMIT,
    ACTION_DELIVER,
    DELIVERY_TARGET,
    EVENT_SCHEMA,
    GATE_FRACTION,
    KEY,
    RECORD_SCHEMA,
    SKIPPED,
    SUCCESS,
)
from tidemark.session import stage
from tidemark.sources import dimension, extracts, ledger
from tidemark.sources.extracts import Format
from tidemark.sources.master import MasterError

logger = logging.getLogger(__name__)

DISTRICT = "district_id"
#: Between a fleet run's id and the district in the ids of its districts' runs.
_AT = "@"
_MASTER = T.StructType(
    RECORD_SCHEMA.fields + [T.StructField("segment", T.StringType()), T.StructField(DISTRICT, T.StringType())]
)
# Events in the order in which a run writes them.
_STARTED, _COMPUTED, _DELIVERED, _COMMITTED, _ENDED = 0, 4, 5, 6, 7


def district_of(run_id):
    return F.substring_index(run_id, _AT, -1)


@dataclass(frozen=True)
class Fleet:
    """Where many districts keep their exchange together."""

    spark: SparkSession
    root: str
    now: object = field(default=utc_now)

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"

    @property
    def delivery_path(self) -> str:
        return f"{self.root}/delivery"

    @property
    def archive_path(self) -> str:
        return f"{self.root}/archive"

    @property
    def master_path(self) -> str:
        return f"{self.root}/master"

    def events(self) -> DataFrame:
        return ledger.read(self.spark, self.ledger_path)

    def commits(self, events: DataFrame | None = None) -> DataFrame:
        """``district_id, segment, records, digest``: one row per commit."""
        events = self.events() if events is None else events
        data = F.col("data")
        return events.where(F.col("type") == "MasterCommitted").select(
            district_of(F.col("run_id")).alias(DISTRICT),
            data["snapshot_path"].alias("segment"),
            data["record_count"].cast("long").alias("records"),
            F.substring_index(data["master_hash"], "-", -1).cast("decimal(38,0)").alias("digest"),
        )

    def known(self, commits: DataFrame | None = None) -> DataFrame:
        """``district_id`` and the records every district has committed."""
        commits = stage(self.commits() if commits is None else commits, "commits")
        pairs = commits.select(DISTRICT, "segment").distinct()
        # One name per fleet run, as a listing of the table gives them too.
        names = sorted(row["segment"] for row in pairs.select("segment").distinct().collect())
        if not names:
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA]
            return self.spark.range(0).select(F.lit("").alias(DISTRICT), *nothing)
        table = (
            self.spark.read.schema(_MASTER).option("basePath", self.master_path)
            .parquet(*[f"{self.master_path}/segment={name}" for name in names])
        )
        return table.join(pairs, [DISTRICT, "segment"], "left_semi").select(DISTRICT, *KEY)

    def write_segment(self, new: DataFrame, segment: str) -> None:
        """Write new records of many districts; the name is the content, so again is the same."""
        ordered = new.repartitionByRange(DISTRICT, *KEY).sortWithinPartitions(DISTRICT, *KEY)
        path = f"{self.master_path}/segment={segment}"
        ordered.select(DISTRICT, *KEY).write.mode("overwrite").partitionBy(DISTRICT).parquet(path)


def versions(commits: DataFrame) -> DataFrame:
    """``district_id, known_count, known_digest``: a master only grows, so its largest count is the newest."""
    newest = F.max(F.struct("records", "digest"))
    return commits.groupBy(DISTRICT).agg(newest.alias("v")).select(
        DISTRICT, F.col("v.records").alias("known_count"), F.col("v.digest").alias("known_digest")
    )


def _batch(landing: extracts.Landing, found: DataFrame) -> DataFrame:
    """The distinct records of each district, from the extracts its schools' listings name."""
    owners = found.where("accepted and school_id is not null").select(DISTRICT, "name")
    rows = landing.records.withColumn("name", sources.landed_name(F.col("file")))
    return rows.join(owners, "name").select(DISTRICT, *KEY).dropDuplicates([DISTRICT, *KEY])


def _new(fleet: Fleet, batch: DataFrame, commits: DataFrame) -> DataFrame:
    """The records of the batch that their district has not committed."""
    key, size = [DISTRICT, *KEY], records.measure(batch, [DISTRICT])
    known = fleet.known(commits)
    if size.fits(records.BROADCAST_BYTES):
        return records.diff_broadcast(batch, known, key)
    return records.diff(batch, known, key)


def _added(new: DataFrame) -> DataFrame:
    """``district_id, new_count, new_digest, named_digest``: what is new, digested once.

    The last is the digest of records with their district; see :func:`_content_name`.
    """
    line = F.concat_ws("\n", DISTRICT, record_line())
    return new.groupBy(DISTRICT).agg(
        F.count(F.lit(1)).alias("new_count"),
        digest_sum(record_line()).alias("new_digest"),
        digest_sum(line).alias("named_digest"),
    )


def _metrics(found: DataFrame, batch: DataFrame, added: DataFrame, known: DataFrame) -> DataFrame:
    """One row per district: what its decision depends on."""
    total = batch.groupBy(DISTRICT).agg(F.count(F.lit(1)).alias("total_count"))
    added = added.select(DISTRICT, "new_count", "new_digest")
    joined = sources.counts(found)
    for part in (total, added, known):
        joined = joined.join(part, DISTRICT, "left")
    numbers = ["total_count", "new_count", "known_count", "new_digest", "known_digest"]
    filled = {name: F.coalesce(name, F.lit(0).cast(joined.schema[name].dataType)) for name in numbers}
    fixed = {"query_submitted": True, "staging_deadline_passed": True, "has_diff": True,
             "delivered": False, "master_committed": False}
    return joined.withColumns(filled).withColumns({name: F.lit(value) for name, value in fixed.items()})


def _decided(fleet: Fleet, metrics: DataFrame, run_id: str, as_of: dt.date, fraction: float | None) -> DataFrame:
    """The metrics with each district's run, content name, decision and outcome."""
    named = metrics.withColumns(
        {
            "run_id": F.concat(F.lit(run_id + _AT), DISTRICT),
            "file_name": F.lit(diff_name(as_of)),
            "remote_id": F.concat_ws("-", F.col("new_count").cast("string"), F.col("new_digest").cast("string")),
        }
    )
    done = runs.deliveries(fleet.events()).select(
        district_of(F.col("run_id")).alias(DISTRICT), "file_name", "remote_id"
    )
    done = done.distinct().withColumn("delivered_elsewhere", F.lit(True))
    named = named.join(done, [DISTRICT, "file_name", "remote_id"], "left").withColumn(
        "delivered_elsewhere", F.coalesce("delivered_elsewhere", F.lit(False))
    )
    decided = named.withColumn("d", gate.next_step(F.lit(fraction).cast("double")))
    passes = F.col("d.action") == ACTION_DELIVER
    after = F.when(F.col("delivered_elsewhere"), F.lit(SKIPPED)).otherwise(F.lit(SUCCESS))
    return decided.withColumns(
        {"passes": passes, "status": F.when(passes, after).otherwise(F.col("d.status"))}
    )


def _run_events(decided: DataFrame, segment: str, trigger: str) -> DataFrame:
    """Events of the run itself, in the shape of :func:`sources.events`."""
    c, text = F.col, F.lit
    version = F.concat_ws("-", c("known_count").cast("string"), c("known_digest").cast("string"))
    after_count, after_digest = c("known_count") + c("new_count"), c("known_digest") + c("new_digest")
    after = F.concat_ws("-", after_count.cast("string"), after_digest.cast("string"))

    def told(rank: int, kind: str, /, **values):
        return F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("type"), payload(kind, **values).alias("data"))

    closing = gate.terminal_event(
        c("status"), c("d.step"), c("d.error"), text("diff already delivered by another run"),
        schools=c("school_count"), files_transformed=c("files_transformed"),
        new_records=c("new_count"), fetch_failures=c("fetch_failures"),
        submission_failures=c("submission_failures"),
    )
    each = F.array(
        told(_STARTED, "RunStarted", kind=text("run"), trigger=text(trigger)),
        told(_COMPUTED, "DiffComputed", new_count=c("new_count"), total_count=c("total_count"),
             known_hash=version, diff_hash=c("remote_id")),
        F.when(
            c("passes") & ~c("delivered_elsewhere"),
            told(_DELIVERED, "Delivered", file_name=c("file_name"), target=text(DELIVERY_TARGET),
                 remote_id=c("remote_id")),
        ),
        F.when(
            c("passes"),
            told(_COMMITTED, "MasterCommitted", master_hash=after, record_count=after_count,
                 snapshot_path=text(segment), base=version),
        ),
        F.struct(F.lit(_ENDED).alias("rank"), closing["type"].alias("type"), closing["data"].alias("data")),
    )
    return decided.select(DISTRICT, F.explode(F.array_compact(each)).alias("event")).select(
        DISTRICT, "event.rank", F.lit("").alias("school_id"), "event.type", "event.data"
    )


def _append(fleet: Fleet, events: DataFrame, required: bool = False) -> None:
    """Append events of many runs in one write; best effort unless ``required``."""
    stamp = F.lit(fleet.now().replace(microsecond=0)).cast("timestamp_ntz")
    try:
        ledger.append(events.withColumn("at", stamp).select(*EVENT_SCHEMA.fieldNames()), fleet.ledger_path)
    except Exception as error:  # noqa: BLE001
        if required:
            raise
        logger.warning("ledger append failed: %s", type(error).__name__)


def _failed(fleet: Fleet, events: DataFrame, step: str, error: Exception) -> None:
    """Close the runs that were to deliver; their commits were not written."""
    told = payload("RunFailed", step=F.lit(step), error=F.lit(type(error).__name__))
    open_runs = events.where(F.col("rank") == _COMMITTED)
    _append(fleet, open_runs.select("run_id", "seq", F.lit("RunFailed").alias("type"), told.alias("data")))


def deliver(fleet: Fleet, new: DataFrame, decided: DataFrame, as_of: dt.date) -> None:
    """One dated import file for each district that passes, named by its content."""
    files = decided.where("passes and not delivered_elsewhere").select(DISTRICT, "remote_id", "file_name")
    rows = new.join(files, DISTRICT)
    ordered = rows.repartitionByRange(DISTRICT, *KEY).sortWithinPartitions(DISTRICT, *KEY)
    lines = ordered.select(
        DISTRICT, F.lit(as_of.isoformat()).alias("date"), F.col("remote_id").alias("fp"), "file_name",
        record_line().alias("value"),
    )
    # A rerun replaces the files it writes and leaves all others.
    (
        lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(DISTRICT, "date", "fp", "file_name").text(fleet.delivery_path, lineSep="\n")
    )


def run_fleet(
    fleet: Fleet,
    config: DataFrame,
    listings: DataFrame,
    rosters: DataFrame,
    paths: list[str],
    fmt: Format,
    as_of: dt.date,
    *,
    fraction: float | None = GATE_FRACTION,
    trigger: str = "scheduled",
    run_id: str | None = None,
) -> DataFrame:
    """Take one landing for all configured districts; one row per district says how it went.

    ``config`` holds a document per district, ``listings`` the results listing of
    each school (``district_id, school_id, body``), ``rosters`` the digests of the
    roster files by ``path``.  A school's records are those of the extract that
    its newest listing entry names.  ``fraction`` None turns the gate off.
    """
    run_id = run_id or new_run_id("fleet", fleet.now())
    landing = extracts.read_landing(fleet.spark, paths, fmt)
    entries = listings.select(
        DISTRICT, "school_id", F.struct(DISTRICT, "school_id").alias("_school"), "body"
    )
    latest = coverage.latest(
        dimension.listing_entries(entries, "_school", "body"), ["_school"], "url", ["uploaded", "position"]
    ).select("_school.*", "url")
    found = sources.by_school(
        dimension.schools(config), latest, rosters, sources.landed(landing.files, landing.rejects)
    )
    found = stage(found, "sources")
    commits = stage(fleet.commits(), "commits")
    known = stage(versions(commits), "versions")
    batch = stage(_batch(landing, found), "batch")
    new = stage(_new(fleet, batch, commits), "new")
    added = stage(_added(new), "added")
    decided = _decided(fleet, _metrics(found, batch, added, known), run_id, as_of, fraction)
    decided = stage(decided, "decided")
    passes = decided.where("passes").select(DISTRICT)
    passing = new.join(passes, DISTRICT, "left_semi")
    segment, count = _content_name(added.join(passes, DISTRICT, "left_semi"))
    told = sources.events(found).unionByName(_run_events(decided, segment, trigger))
    told = told.withColumn("run_id", F.concat(F.lit(run_id + _AT), DISTRICT))
    events = stage(numbering.sequence(told, ["run_id"], ["rank", "school_id"]), "events")
    _append(fleet, events.where(F.col("rank") <= _COMPUTED))
    _archive(fleet, new, added, as_of)
    step = ACTION_DELIVER
    try:
        if count:
            deliver(fleet, new, decided, as_of)
            _append(fleet, events.where(F.col("rank") == _DELIVERED))
            step = ACTION_COMMIT
            fleet.write_segment(passing, segment)
            if not _unchanged(versions(fleet.commits()), known):
                raise MasterError("another run committed first; what it lacks is new next time")
        _append(fleet, events.where(F.col("rank") >= _COMMITTED), required=True)
    except Exception as error:
        _failed(fleet, events, step, error)
        raise
    return decided.select(
        DISTRICT, "run_id", "status", F.col("d.step").alias("step"), F.col("d.error").alias("error"),
        "school_count", "staged", "files_transformed", "fetch_failures", "submission_failures",
        "total_count", "new_count", "known_count",
    )


def _content_name(added: DataFrame) -> tuple[str, int]:
    """A name for records of many districts, which are part of it, and how many they are.

    Digests are sums, so those of the districts add up to that of all records.
    """
    none = F.lit(0).cast("decimal(38,0)")
    row = added.agg(
        F.coalesce(F.sum("new_count"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("named_digest"), none).cast("string").alias("digest"),
    ).first()
    return f"{row['n']}-{row['digest']}", row["n"]


def _unchanged(now: DataFrame, before: DataFrame) -> bool:
    return now.exceptAll(before).isEmpty()


def _archive(fleet: Fleet, new: DataFrame, added: DataFrame, as_of: dt.date) -> None:
    """A copy of all that is new, kept even of districts the gate stops.  Best effort."""
    try:
        name, count = _content_name(added)
        if count:
            path = f"{fleet.archive_path}/date={as_of.isoformat()}/fp={name}"
            new.write.mode("ignore").partitionBy(DISTRICT).parquet(path)
    except Exception as error:  # noqa: BLE001
        logger.warning("archive failed: %s", type(error).__name__)
