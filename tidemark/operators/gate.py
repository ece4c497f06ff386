"""Volume gate and next-step decision, as columns over one state row per run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tidemark.functions.events import event
from tidemark.schema import (
    ACTION_COMMIT,
    ACTION_COMPUTE,
    ACTION_DELIVER,
    ACTION_FINISH,
    ACTION_SUBMIT,
    ACTION_WAIT,
    ALL_FAILED,
    BLOCKED,
    FAILED,
    GATE_FLOOR,
    NOTHING_STAGED,
    SKIPPED,
    STEP_FETCH,
    STEP_GATE,
    SUCCESS,
    TOO_LARGE,
)


def gate_limit(known: Column, fraction: Column) -> Column:
    """The most new records a diff may hold; null if the gate is off.

    The product is a double, as 0.29 of 100 is 28 in doubles and 29 in decimals.
    """
    share = F.floor(fraction.cast("double") * known.cast("double"))
    limit = F.greatest(F.lit(GATE_FLOOR).cast("long"), share)
    return F.when(fraction.isNotNull(), limit)


def suspicious(new: Column, known: Column, fraction: Column) -> Column:
    """True when a diff is far larger than history.

    A first run (nothing known) always passes; a null fraction turns the gate
    off.
    """
    return F.coalesce((known > 0) & (new > gate_limit(known, fraction)), F.lit(False))


def _outcome(action: str, status: str = "", step: str = "", error: str = "") -> Column:
    return F.struct(
        F.lit(action).alias("action"),
        F.lit(status).alias("status"),
        F.lit(step).alias("step"),
        F.lit(error).alias("error"),
    )


def next_step(fraction: Column) -> Column:
    """What a run does next, given its state columns; the first rule that
    holds wins.

    State: ``query_submitted, staged, school_count, staging_deadline_passed,
    has_diff, new_count, known_count, files_transformed, fetch_failures,
    delivered, delivered_elsewhere, master_committed``.
    """
    c = F.col
    rules = [
        (~c("query_submitted"), _outcome(ACTION_SUBMIT)),
        (
            (c("staged") < c("school_count")) & ~c("staging_deadline_passed"),
            _outcome(ACTION_WAIT),
        ),
        (
            c("staged") == 0,
            _outcome(ACTION_FINISH, FAILED, ACTION_WAIT, NOTHING_STAGED),
        ),
        (~c("has_diff"), _outcome(ACTION_COMPUTE)),
        (
            (c("files_transformed") == 0) & (c("fetch_failures") > 0),
            _outcome(ACTION_FINISH, FAILED, STEP_FETCH, ALL_FAILED),
        ),
        (c("new_count") == 0, _outcome(ACTION_FINISH, SUCCESS)),
        (
            suspicious(c("new_count"), c("known_count"), fraction),
            _outcome(ACTION_FINISH, BLOCKED, STEP_GATE, TOO_LARGE),
        ),
        (~c("delivered"), _outcome(ACTION_DELIVER)),
        (~c("master_committed"), _outcome(ACTION_COMMIT)),
        (c("delivered_elsewhere"), _outcome(ACTION_FINISH, SKIPPED)),
    ]
    otherwise = _outcome(ACTION_FINISH, SUCCESS)
    return reduce(
        lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest),
        reversed(rules),
        otherwise,
    )


def terminal_event(
    status: Column, step: Column, error: Column, reason: Column, **totals: Column
) -> Column:
    """The one event that closes a run with this status."""
    return (
        F.when(status == SUCCESS, event("RunCompleted", **totals))
        .when(status == SKIPPED, event("RunSkipped", reason=reason))
        .when(status.isin(BLOCKED, FAILED), event("RunFailed", step=step, error=error))
    )


def completeness(staged: Column, expected: Column, deadline_passed: Column) -> Column:
    """Whether a run's sources are all there, still awaited, or given up on."""
    return (
        F.when(staged >= expected, F.lit("full"))
        .when(~deadline_passed, F.lit("waiting"))
        .when(staged > 0, F.lit("partial"))
        .otherwise(F.lit("none"))
    )
