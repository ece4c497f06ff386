import datetime as dt
import glob
import json

from pyspark.sql import functions as F

from tidemark.operators import reconcile, runs
from tidemark.schema import EVENT_SCHEMA, NO_TERMINAL
from tidemark.sources import ledger
from tidemark.sources.ledger import RunLedger

NOON = dt.datetime(2026, 7, 22, 9, 0, 0)


def clock(*times):
    left = list(times)
    return lambda: left.pop(0) if len(left) > 1 else left[0]


def make(spark, rows):
    """Events whose payloads keep the order they were written in."""
    rows = [(*row[:4], json.dumps(row[4])) for row in rows]
    made = spark.createDataFrame(rows, "run_id string, seq int, type string, at timestamp_ntz, data string")
    return made.withColumn("data", F.from_json("data", EVENT_SCHEMA["data"].dataType))


def test_events_are_written_in_sequence_by_month(spark, folder):
    one = RunLedger(spark, folder, "run_x", clock(NOON))
    one.append(("RunStarted", {"kind": "run", "trigger": "scheduled"}))
    one.append(("RunCompleted", {"schools": 8}))
    written = sorted(glob.glob(f"{folder}/year=2026/month=7/*.json"))
    assert len(written) == 2
    lines = sorted((json.loads(open(p).read()) for p in written), key=lambda r: r["seq"])
    assert [r["type"] for r in lines] == ["RunStarted", "RunCompleted"]
    assert lines[0]["data"] == {"kind": "run", "trigger": "scheduled"}
    assert lines[0]["at"].startswith("2026-07-22T09:00:00")


def test_reading_prunes_months_and_passes_over_broken_lines(spark, folder):
    RunLedger(spark, folder, "run_x", clock(NOON)).append(("RunCompleted", {"schools": 8}))
    RunLedger(spark, folder, "old", clock(dt.datetime(2026, 5, 1))).append(("RunCompleted", {}))
    with open(f"{folder}/year=2026/month=7/broken.json", "w") as out:
        out.write('{"run_id": "x", "seq": \nnot json\n{"type": "NoRun"}\n')
    got = ledger.read(spark, folder, [(2026, 7), (2026, 6)])
    assert [(r["run_id"], r["at"]) for r in got.collect()] == [("run_x", NOON)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1][:200]
    assert ledger.read(spark, folder).count() == 2


def test_no_ledger_is_no_events(spark, folder):
    assert ledger.read(spark, f"{folder}/none").count() == 0


def test_a_ledger_that_cannot_be_written_only_stops_what_needs_it(spark):
    broken = RunLedger(spark, "nosuchfs://x/y", "run_x", clock(NOON))
    broken.append(("RunCompleted", {"schools": 8}))
    try:
        broken.append(("RunCompleted", {"schools": 8}), required=True)
    except Exception:
        return
    raise AssertionError("a required event was lost")


def runs_of(spark):
    early, late = dt.datetime(2026, 7, 1, 2), NOON
    return make(spark, [
        ("a", 2, "RunCompleted", early, {"schools": "8", "new": "3"}),
        ("a", 1, "RunStarted", early, {"kind": "run"}),
        ("b", 1, "RunStarted", late, {"kind": "run"}),
        ("c", 1, "RunStarted", early, {}),
        ("c", 2, "RunFailed", late, {"step": "fetch", "error": "E"}),
    ])


def test_the_status_report_is_newest_first_and_shows_open_runs(spark):
    got = [tuple(r)[1:] for r in runs.status_report(runs_of(spark), 10).collect()]
    assert got == [
        ("b", NO_TERMINAL, "last event: RunStarted"),
        ("a", "RunCompleted", "schools=8, new=3"),
        ("c", "RunFailed", "step=fetch, error=E"),
    ]
    assert [r["run_id"] for r in runs.status_report(runs_of(spark), 2).collect()] == ["b", "a"]


def test_summaries_and_events_of_newest_runs(spark):
    got = {r["run_id"]: r for r in runs.summarize(runs_of(spark), ["run_id"]).collect()}
    assert got["c"]["outcome"] == "RunFailed" and got["c"]["events"] == 2
    assert got["b"]["outcome"] == NO_TERMINAL
    assert {r["run_id"] for r in runs.of_newest_runs(runs_of(spark), 1).collect()} == {"b"}


def test_one_claimant_wins(spark):
    at = lambda m: dt.datetime(2026, 7, 22, 9, m)
    rows = [("2026-07-22_diff", "run-b", at(1)), ("2026-07-22_diff", "run-a", at(1)),
            ("2026-07-22_diff", "run-0", at(2)), ("2026-07-23_diff", "run-b", at(3))]
    attempts = spark.createDataFrame(rows, "key string, run_id string, at timestamp_ntz")
    got = {r["key"]: (r["run_id"], r["attempts"]) for r in runs.claim_winners(attempts, ["key"]).collect()}
    assert got == {"2026-07-22_diff": ("run-a", 3), "2026-07-23_diff": ("run-b", 1)}


def delivered(name, target="drive"):
    return ("r", 1, "Delivered", NOON, {"file_name": name, "target": target, "remote_id": ""})


def confirmed(name):
    return ("s", 1, "ImportConfirmed", NOON, {"file_name": name, "how": "deleted from Drive"})


def test_reconciliation(spark):
    new, old, gone, done = (f"{d}_new_vaccinations.csv" for d in
                            ("2026-07-20", "2020-01-01", "2026-07-19", "2026-07-18"))
    events = make(spark, [delivered(new), delivered(old), delivered(gone), delivered(gone),
                          delivered(done), confirmed(done), delivered("elsewhere.csv", "other"),
                          delivered("undated.csv")])
    present = spark.createDataFrame([(n,) for n in (new, old, done, "undated.csv")], "file_name string")
    acks = reconcile.acknowledgements(events)
    status = reconcile.file_status(acks, present, F.lit(dt.date(2026, 7, 22)))
    assert {r["file_name"]: r["status"] for r in status.collect()} == {
        new: "awaiting", old: "overdue", gone: "imported", "undated.csv": "awaiting"}
    made = reconcile.confirmations(status).collect()
    assert [(r["type"], r["data"]) for r in made] == [
        ("ImportConfirmed", {"file_name": gone, "how": "deleted from Drive"})]
    left = reconcile.outstanding(acks, ["file_name"]).collect()
    assert {r["file_name"] for r in left} == {new, old, gone, "undated.csv"}


def test_earlier_deliveries_count_by_day_and_content(spark):
    events = make(spark, [("r", 1, "Delivered", NOON,
                           {"file_name": "f", "target": "drive", "remote_id": "3-99"})])
    done = runs.deliveries(events)
    wanted = spark.createDataFrame([("f", "3-99"), ("f", "3-98")], "file_name string, remote_id string")
    got = runs.already_delivered(wanted, done, ["file_name", "remote_id"]).collect()
    assert [r["remote_id"] for r in got] == ["3-99"]
