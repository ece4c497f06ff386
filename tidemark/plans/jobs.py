"""Incremental run, rebaseline, reconciliation, readiness and status.

Order of an incremental run: archive, gate, deliver, commit.  Each step names
what it writes by content, so a run that stopped anywhere can be run again:
what is there already is not done twice, and nothing enters the master that
was not delivered before.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.events import payload
from tidemark.functions.names import chunk_name, new_run_id
from tidemark.operators import coverage, gate, reconcile, records, runs
from tidemark.plans.store import Store
from tidemark.schema import (
    ACTION_COMMIT,
    ACTION_COMPUTE,
    ACTION_DELIVER,
    CHUNK_RECORDS,
    DELIVERY_TARGET,
    EMPTY_MASTER,
    FAILED,
    GATE_FRACTION,
    KEY,
    REMINDER_DAYS,
    SKIPPED,
    STATUS_MONTHS,
    STATUS_RUNS,
    STEP_READINESS,
    STEP_REBASELINE,
    SUCCESS,
)
from tidemark.session import stage
from tidemark.sinks import export
from tidemark.sources import dimension, extracts, files
from tidemark.sources.extracts import Format
from tidemark.sources.ledger import RunLedger, is_missing
from tidemark.sources.master import MasterError, Version, commit_event, describe

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    """How a run ended.  Counts only, never record content."""

    run_id: str
    status: str
    step: str = ""
    error: str = ""
    new_count: int = 0
    known_count: int = 0
    files_transformed: int = 0
    fetch_failures: int = 0
    delivered_path: str = ""


@contextmanager
def _during(ledger: RunLedger, step: str) -> Iterator[None]:
    """What is raised inside closes the run under the name of its step."""
    try:
        yield
    except Exception as error:
        ledger.append(("RunFailed", {"step": step, "error": type(error).__name__}))
        raise


def _verdict(store: Store, fraction: float | None, **metrics: int) -> tuple:
    """The decision on a run's metrics, and its closing event if nothing is to deliver."""
    fixed = {"query_submitted": True, "staging_deadline_passed": True, "has_diff": True}
    later = {"delivered": False, "delivered_elsewhere": False, "master_committed": False}
    row = store.spark.createDataFrame(pa.Table.from_pylist([metrics | fixed | later]))
    decided = row.withColumn("d", gate.next_step(F.lit(fraction).cast("double")))
    told = decided.select("d", _closing(F.col("d.status"), F.col("d.step"), F.col("d.error")))
    return told.first()


def _closing(status, step, error):
    """The event that ends a run with ``status``, from the metrics of its row."""
    return gate.terminal_event(
        status,
        step,
        error,
        F.lit("diff already delivered by another run"),
        schools=F.col("school_count"),
        files_transformed=F.col("files_transformed"),
        new_records=F.col("new_count"),
        fetch_failures=F.col("fetch_failures"),
    ).alias("closing")


def _landing(store: Store, paths: list[str], fmt: Format):
    """The landing, and how many files lie in it, empty ones too; none if there is no file."""
    try:
        text = store.spark.read.text(paths)  # listed once
        listed = files.count_files(store.spark, paths, text)
        return extracts.read_landing(store.spark, paths, fmt, text), listed
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return None, 0


def _fetched(listed: DataFrame) -> DataFrame:
    """A RecordsFetched event per file, in the order of their names; one row per file."""
    return listed.select(
        F.row_number().over(Window.orderBy("file")).cast("long").alias("seq"),
        F.lit("RecordsFetched").alias("type"),
        payload(
            "RecordsFetched",
            school_id=F.substring_index("file", "/", -1),
            content_hash=F.col("content_hash"),
            byte_size=F.col("bytes"),
        ).alias("data"),
    )


def run_incremental(
    store: Store,
    paths: list[str],
    fmt: Format,
    as_of: dt.date,
    *,
    expected_sources: int | None = None,
    fraction: float | None = GATE_FRACTION,
    trigger: str = "scheduled",
    run_id: str | None = None,
) -> Outcome:
    """Take a landing of files, deliver what is new, then advance the master.

    ``expected_sources`` is how many files should have come; missing, empty and
    rejected ones count as failures.  ``fraction`` None turns the gate off.
    """
    run_id = run_id or new_run_id("run", store.now())
    ledger = store.run_ledger(run_id)
    ledger.append(("RunStarted", {"kind": "run", "trigger": trigger}))
    run_reconciliation(store, as_of, ledger=ledger)

    with _during(ledger, ACTION_COMPUTE):
        version = store.version()
        known = store.master.read(version)
        landing, staged = _landing(store, paths, fmt)
        accepted = new_count = 0
        segment = file_name = ""
        if landing:
            counts = landing.files.agg(
                F.count(F.lit(1)).alias("read"), F.sum(F.col("accepted").cast("long")).alias("ok")
            ).first()
            accepted = counts["ok"] or 0
            ledger.append_rows(_fetched(landing.files))
            ledger.seq += counts["read"]
            current = stage(extracts.combine(landing), "current")
            size = records.measure(current)
            partitions = store.master.buckets() or 1
            new = stage(records.new_records(current, known, size, partitions), "new")
            segment, new_count, digest = describe(new)
            after = version.plus(segment, new_count, digest)
            ledger.append(
                (
                    "DiffComputed",
                    {
                        "new_count": new_count,
                        "total_count": size.rows,
                        "known_hash": version.name,
                        "diff_hash": segment,
                    },
                )
            )
        expected = max(staged, expected_sources or 0)
        decision, closing = _verdict(
            store,
            fraction,
            staged=staged,
            school_count=expected,
            new_count=new_count,
            known_count=version.records,
            files_transformed=accepted,
            fetch_failures=expected - accepted,
        )
    # A copy is kept even of what the gate stops.
    if new_count:
        export.archive(new, store.archive_path, as_of, segment)

    status, path = decision["status"], ""
    if decision["action"] == ACTION_DELIVER:
        file_name = export.diff_name(as_of)
        elsewhere = _delivered_before(store, file_name, segment)
        status = SKIPPED if elsewhere else SUCCESS
        if not elsewhere:
            with _during(ledger, ACTION_DELIVER):
                path = export.write_diff(new, store.delivery_path, as_of, segment)
            sent = {"file_name": file_name, "target": DELIVERY_TARGET, "remote_id": segment}
            ledger.append(("Delivered", sent))
        with _during(ledger, ACTION_COMMIT):
            # Exactly the set that was delivered, as staged above.
            store.master.write_segment(new, segment)
            ledger.append(commit_event(version, after, segment), required=True)
            if store.version().name != after.name:
                raise MasterError("another run committed first; what it lacks is new next time")
        closing = _ended(store, status, expected, accepted, new_count)
    ledger.append((closing["type"], dict(closing["data"])))
    return Outcome(
        run_id,
        status,
        decision["step"],
        decision["error"],
        new_count,
        version.records,
        accepted,
        expected - accepted,
        path,
    )


def _ended(store: Store, status: str, expected: int, accepted: int, new_count: int):
    """The closing event of a run that delivered, or found that another had."""
    metrics = {
        "school_count": expected,
        "files_transformed": accepted,
        "new_count": new_count,
        "fetch_failures": expected - accepted,
    }
    row = store.spark.createDataFrame(pa.Table.from_pylist([metrics]))
    return row.select(_closing(F.lit(status), F.lit(""), F.lit(""))).first()["closing"]


def _delivered_before(store: Store, file_name: str, remote_id: str) -> bool:
    """Whether any run delivered this file with this content.

    The day alone does not tell two diffs of one day apart, so the content
    name is part of the question.  Best effort: a ledger that cannot be read
    says no, and the file is delivered again under the same name.
    """
    wanted = (F.col("file_name") == file_name) & (F.col("remote_id") == remote_id)
    try:
        return not runs.deliveries(store.events()).filter(wanted).isEmpty()
    except Exception as error:  # noqa: BLE001
        logger.warning("earlier deliveries unknown: %s", type(error).__name__)
        return False


def run_rebaseline(
    store: Store,
    as_of: dt.date,
    *,
    size: int = CHUNK_RECORDS,
    trigger: str = "manual",
    run_id: str | None = None,
) -> Outcome:
    """Export everything known in numbered files of at most ``size`` rows.

    The export is named by its day, the master's version and the size, so a
    rerun writes and announces nothing that is there already.
    """
    run_id = run_id or new_run_id("rebaseline", store.now())
    ledger = store.run_ledger(run_id)
    ledger.append(("RunStarted", {"kind": "rebaseline", "trigger": trigger}))
    with _during(ledger, STEP_REBASELINE):
        version = store.version()
        if not version.records:
            ledger.append(("RunFailed", {"step": STEP_REBASELINE, "error": EMPTY_MASTER}))
            return Outcome(run_id, FAILED, STEP_REBASELINE, EMPTY_MASTER)
        total = -(-version.records // size)
        content = f"{as_of.isoformat()}-{version.name}-{size}"
        path = f"{store.delivery_path}/rebaseline/{content}"
        last = chunk_name(F.lit(as_of.isoformat()), F.lit(total), F.lit(total))
        last = store.spark.range(1).select(last.alias("name")).first()["name"]
        if _delivered_before(store, last, content):
            ledger.append(("RunSkipped", {"reason": "export already delivered by another run"}))
            return Outcome(run_id, SKIPPED, known_count=version.records, delivered_path=path)
        export.write_chunks(store.master.read(version), path, as_of, size)
        ledger.append_rows(_chunk_deliveries(store, as_of, total, content))
        ledger.seq += total
        ledger.append(("RunCompleted", {"chunks": total, "records": version.records}))
    return Outcome(
        run_id, SUCCESS, known_count=version.records, files_transformed=total,
        delivered_path=path,
    )


def _chunk_deliveries(store: Store, as_of: dt.date, total: int, content: str) -> DataFrame:
    """A Delivered event per chunk, made where they are written."""
    chunk = store.spark.range(1, total + 1).withColumnRenamed("id", "seq")
    name = chunk_name(F.lit(as_of.isoformat()), F.col("seq"), F.lit(total))
    sent = payload(
        "Delivered", file_name=name, target=F.lit(DELIVERY_TARGET), remote_id=F.lit(content)
    )
    return chunk.select("seq", F.lit("Delivered").alias("type"), sent.alias("data"))


def run_reconciliation(
    store: Store,
    as_of: dt.date,
    *,
    ledger: RunLedger | None = None,
    days: int = REMINDER_DAYS,
) -> DataFrame | None:
    """Record which delivered files have been imported since.

    All deliveries of all time are looked at; ages are by ``as_of``.  Best
    effort: whatever goes wrong here must not stop a delivery.  Returns the
    status of each outstanding delivery.
    """
    try:
        acks = reconcile.acknowledgements(store.events())
        present = files.folder_names(store.spark, store.delivery_path)
        status = reconcile.file_status(acks, present, F.lit(as_of), days)
        status = stage(status, "file-status")
        found = status.groupBy().agg(
            F.count(F.lit(1)).alias("all"),
            F.count_if(F.col("status") == "imported").alias("imported"),
            F.count_if(F.col("status") == "overdue").alias("overdue"),
        ).first()
        if not found["all"]:
            return None
        if found["imported"]:
            ledger = ledger or store.run_ledger(new_run_id("reconcile", store.now()))
            gone = reconcile.confirmations(status)
            order = Window.orderBy("file_name", F.col("data")["remote_id"])
            ledger.append_rows(gone.withColumn("seq", F.row_number().over(order).cast("long")))
            ledger.seq += found["imported"]
        if found["overdue"]:
            logger.warning("%d delivered file(s) still await import", found["overdue"])
        return status
    except Exception as error:  # noqa: BLE001
        logger.warning("reconciliation skipped: %s", type(error).__name__)
        return None


def readiness(config: DataFrame, listings: DataFrame) -> DataFrame:
    """How many configured sources have results staged; reads, writes nothing."""
    schools = dimension.schools(config)
    entries = dimension.listing_entries(listings, "school_id", "body")
    latest = coverage.latest(entries, ["school_id"], "url", ["uploaded", "position"])
    covered = coverage.with_latest(schools, latest, "school_id", "url")
    return coverage.staged_counts(covered, ["district_id"])


def run_readiness(
    store: Store,
    config: DataFrame,
    listings: DataFrame,
    *,
    trigger: str = "scheduled",
    run_id: str | None = None,
) -> DataFrame:
    """Readiness as a run of its own: counts what is staged, records the totals, delivers nothing.

    Returns the counts of each district.
    """
    run_id = run_id or new_run_id("readiness", store.now())
    ledger = store.run_ledger(run_id)
    ledger.append(("RunStarted", {"kind": "readiness", "trigger": trigger}))
    with _during(ledger, STEP_READINESS):
        counted = stage(readiness(config, listings), "readiness")
        totals = counted.agg(
            F.coalesce(F.sum("school_count"), F.lit(0)).alias("schools"),
            F.coalesce(F.sum("staged"), F.lit(0)).alias("staged"),
        ).first()
    told = {"schools_checked": totals["schools"], "records_available": totals["staged"]}
    ledger.append(("RunCompleted", told))
    return counted


def status(store: Store, as_of: dt.date, limit: int = STATUS_RUNS) -> DataFrame:
    """The newest runs of the last months, by the ledger's clock, and how they ended."""
    return runs.status_report(store.events(STATUS_MONTHS), limit)


def compact(store: Store) -> str:
    """Fold the master's segments into one; readers switch with the event."""
    version = store.version()
    if len(version.segments) < 2:
        return version.name
    whole = stage(store.master.read(version).select(*KEY), "compact")
    segment, count, digest = describe(whole)
    if (count, digest) != (version.records, version.digest):
        raise RuntimeError("the master is not what the ledger says")
    store.master.write_segment(whole, segment)
    run_id = new_run_id("compact", store.now())
    store.run_ledger(run_id).append(
        ("RunStarted", {"kind": "compact", "trigger": "manual"}),
        commit_event(version, Version(count, digest, (segment,)), segment),
        ("RunCompleted", {"records": count}),
        required=True,
    )
    return segment
