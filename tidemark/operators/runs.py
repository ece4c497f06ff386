"""Ledger analytics: runs, their outcomes, claims and earlier deliveries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.events import detail
from tidemark.schema import DELIVERY_TARGET, NO_TERMINAL, STATUS_RUNS, TERMINAL_TYPES


def terminal_code(event_type: Column, terminal: list[str]) -> Column:
    """1.. for a terminal type, 0 for any other."""
    return F.array_position(F.lit(terminal), event_type)


def outcome_of(code: Column, terminal: list[str]) -> Column:
    named = F.when(code > 0, F.element_at(F.lit(terminal), code.cast("int")))
    return F.coalesce(named, F.lit(NO_TERMINAL))


def summarize(
    events: DataFrame, run: list[str], terminal: list[str] = TERMINAL_TYPES
) -> DataFrame:
    """Start, end, event count and outcome of every run.

    All buffers are numbers, so rows fold in a hash aggregate before the
    shuffle whatever share of them one run holds.
    """
    code = terminal_code(F.col("type"), terminal)
    return (
        events.groupBy(*run)
        .agg(
            F.min_by("at", "seq").alias("started"),
            F.max_by("at", "seq").alias("ended"),
            F.count(F.lit(1)).alias("events"),
            F.max_by(code, "seq").alias("_code"),
        )
        .withColumn("outcome", outcome_of(F.col("_code"), terminal))
        .drop("_code")
    )


def newest(summary: DataFrame, run: list[str], limit: int = STATUS_RUNS) -> DataFrame:
    """The runs started last, newest first, ties by run id."""
    return summary.orderBy(F.desc("started"), *run).limit(limit)


def of_newest_runs(events: DataFrame, limit: int) -> DataFrame:
    """All events of the ``limit`` newest runs; the list of runs is broadcast,
    the events stay where they are."""
    starts = events.groupBy("run_id").agg(F.min_by("at", "seq").alias("started"))
    runs = newest(starts, ["run_id"], limit).select("run_id")
    return events.join(F.broadcast(runs), "run_id", "left_semi")


def status_report(events: DataFrame, limit: int = STATUS_RUNS) -> DataFrame:
    """The newest runs with their outcome and what their last event said.

    The runs are picked on numbers alone; only the last events of the picked
    ones, one row per run, are looked at in full.
    """
    picked = newest(summarize(events, ["run_id"]), ["run_id"], limit)
    last = events.groupBy("run_id").agg(F.max("seq").alias("seq"))
    last = last.join(F.broadcast(picked.select("run_id")), "run_id", "left_semi")
    final = events.join(F.broadcast(last), ["run_id", "seq"]).select(
        "run_id", "type", "data"
    )
    said = F.when(
        F.col("outcome") == NO_TERMINAL, F.concat(F.lit("last event: "), F.col("type"))
    ).otherwise(detail(F.col("data")))
    return (
        picked.join(F.broadcast(final), "run_id", "left")
        .select("started", "run_id", "outcome", said.alias("detail"))
        .orderBy(F.desc("started"), "run_id")
    )


def claim_winners(attempts: DataFrame, key: list[str]) -> DataFrame:
    """The first claimant of each key, ties by run id, with what it took."""
    return attempts.groupBy(*key).agg(
        F.min_by("run_id", F.struct("at", "run_id")).alias("run_id"),
        F.min("at").alias("at"),
        F.count(F.lit(1)).alias("attempts"),
    )


def deliveries(events: DataFrame, target: str = DELIVERY_TARGET) -> DataFrame:
    """Delivered events to one target, as file names and remote ids."""
    return events.filter(
        (F.col("type") == "Delivered") & (F.col("data")["target"] == target)
    ).select(
        "run_id",
        F.col("data")["file_name"].alias("file_name"),
        F.col("data")["remote_id"].alias("remote_id"),
    )


def already_delivered(candidates: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Candidates some run delivered before, by day and content."""
    return candidates.join(done.select(*on).distinct(), on, "left_semi")
