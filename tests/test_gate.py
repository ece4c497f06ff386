import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.functions.events import detail
from tidemark.operators import gate

DEFAULTS = {
    "query_submitted": True, "staged": 8, "school_count": 8, "staging_deadline_passed": False,
    "has_diff": True, "new_count": 648, "known_count": 170361, "files_transformed": 8,
    "fetch_failures": 0, "delivered": False, "delivered_elsewhere": False,
    "master_committed": False,
}


def decide(spark, states, fraction=0.2):
    columns = list(DEFAULTS)
    rows = [tuple({**DEFAULTS, **state}[c] for c in columns) + (i,) for i, state in enumerate(states)]
    df = spark.createDataFrame(rows, [*columns, "i"])
    step = gate.next_step(F.lit(fraction).cast("double"))
    got = df.select("i", step.alias("s")).orderBy("i").collect()
    return [tuple(r["s"]) for r in got]


@pytest.mark.parametrize(
    "new, known, blocked",
    [(4200, 0, False), (40, 4000, False), (3900, 4000, True), (45, 100, False), (51, 100, True),
     (50, 100, False), (800, 4000, False), (801, 4000, True), (1, 1, False)],
)
def test_the_gate(spark, new, known, blocked):
    row = spark.range(1).select(
        gate.suspicious(F.lit(new), F.lit(known), F.lit(0.2)),
        gate.suspicious(F.lit(new), F.lit(known), F.lit(None).cast("double")),
    ).first()
    assert list(row) == [blocked, False]


def test_the_gate_multiplies_in_doubles(spark):
    limit = gate.gate_limit(F.lit(1000), F.lit(0.29))
    assert spark.range(1).select(limit).first()[0] == int(0.29 * 1000)


def test_every_rule_of_the_decision(spark):
    done = {"delivered": True}
    cases = [
        ({"query_submitted": False}, ("submit_queries", "", "", "")),
        ({"staged": 3}, ("awaiting_results", "", "", "")),
        ({"has_diff": False}, ("compute_diff", "", "", "")),
        ({"staged": 0, "staging_deadline_passed": True},
         ("finish", "failed", "awaiting_results", "NoResultsStaged")),
        ({"staged": 5, "staging_deadline_passed": True, "has_diff": False},
         ("compute_diff", "", "", "")),
        ({"files_transformed": 0, "fetch_failures": 8, "new_count": 0},
         ("finish", "failed", "fetch", "AllDownloadsFailed")),
        ({"new_count": 0}, ("finish", "success", "", "")),
        ({"new_count": 100000}, ("finish", "blocked", "diff_sanity", "SuspiciousDiffVolume")),
        ({"new_count": 4200, "known_count": 0}, ("deliver_diff", "", "", "")),
        ({}, ("deliver_diff", "", "", "")),
        (done, ("commit_master", "", "", "")),
        ({**done, "master_committed": True}, ("finish", "success", "", "")),
        ({**done, "delivered_elsewhere": True}, ("commit_master", "", "", "")),
        ({**done, "delivered_elsewhere": True, "master_committed": True},
         ("finish", "skipped", "", "")),
    ]
    assert decide(spark, [state for state, _ in cases]) == [step for _, step in cases]


def test_the_gate_can_be_turned_off(spark):
    assert decide(spark, [{"new_count": 100000}], None) == [("deliver_diff", "", "", "")]


def test_no_state_commits_before_it_delivered_or_passes_a_blocked_diff(spark):
    flags = ["query_submitted", "staging_deadline_passed", "has_diff", "delivered", "master_committed"]
    states = [
        {**dict(zip(flags, bits)), "staged": staged, "new_count": new}
        for bits in itertools.product([False, True], repeat=5)
        for staged in (0, 4, 8)
        for new in (0, 10, 100000)
    ]
    for state, step in zip(states, decide(spark, states)):
        if step[0] == "commit_master":
            assert state["delivered"] and state["has_diff"]
        if state["new_count"] == 100000:
            assert step[0] not in ("deliver_diff", "commit_master")


def test_terminal_events(spark):
    for status, wanted in [
        ("success", ("RunCompleted", "new_records=3")),
        ("skipped", ("RunSkipped", "reason=r")),
        ("blocked", ("RunFailed", "step=s, error=E")),
        ("failed", ("RunFailed", "step=s, error=E")),
    ]:
        made = gate.terminal_event(F.lit(status), F.lit("s"), F.lit("E"), F.lit("r"), new_records=F.lit(3))
        row = spark.range(1).select(made.alias("e")).select("e.type", detail(F.col("e.data"))).first()
        assert tuple(row) == wanted


def test_completeness(spark):
    cases = [(8, 8, False, "full"), (3, 8, False, "waiting"), (3, 8, True, "partial"), (0, 8, True, "none")]
    for staged, expected, passed, wanted in cases:
        got = gate.completeness(F.lit(staged), F.lit(expected), F.lit(passed))
        assert spark.range(1).select(got).first()[0] == wanted
