"""The ledger folded by month."""

import datetime as dt

import pytest

from tidemark.plans.store import Store
from tidemark.schema import EVENT_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources import ledger, months
from tidemark.sources.ledger import RunLedger
from tidemark.sources.master import Version, commit_event, committed


def rows_of(frame):
    return sorted((r["run_id"], r["seq"], r["type"], r["at"], tuple(sorted(r["data"].items()))) for r in frame.collect())


def at(month, day):
    return dt.datetime(2024 + (month - 1) // 12, (month - 1) % 12 + 1, day)


def begin(store, run, month, day):
    one = RunLedger(store.spark, store.ledger_path, run, lambda: at(month, day))
    one.append(("RunStarted", {"kind": "run", "trigger": "t"}))
    return one


@pytest.fixture(scope="module")
def store(spark):
    """A year of runs; some end in the month after they began; every third commits."""
    store = Store(spark, scratch_path(spark, "store"), now=lambda: at(13, 10))
    version = Version()
    for month in range(1, 13):
        late = begin(store, f"late{month:02d}", month, 28)
        run = begin(store, f"run{month:02d}", month, 5)
        if month % 3 == 0:
            after = version.plus(f"2-{month}", 2, month)
            run.append(commit_event(version, after, f"2-{month}"), required=True)
            version = after
        late.now = lambda month=month: at(month + 1, 1)
        late.append(("RunCompleted", {"records": month}))
    return store, version


def test_folding_changes_nothing_that_is_read(store, spark):
    store, version = store
    before, windowed = rows_of(store.events()), rows_of(store.events(3))
    assert before == rows_of(ledger.read(spark, store.ledger_path)) and len(before) == 40
    assert store.version() == version
    newest = {n: rows_of(store.recent(n)) for n in (1, 5, 23, 100)}
    folded = store.fold()
    assert folded == [months.number_of(2024, month) for month in range(1, 12)]
    assert store.fold() == []
    assert rows_of(store.events()) == before and rows_of(store.events(3)) == windowed
    assert store.version() == version == committed(store.events())
    assert {n: rows_of(store.recent(n)) for n in newest} == newest
    assert {r[0] for r in newest[5]} == {"late12", "run12", "late11", "run11", "late10"}
    begin(store, "next", 13, 9).append(commit_event(version, version.plus("1-9", 1, 9), "1-9"))
    assert store.version() == version.plus("1-9", 1, 9)
    store = Store(spark, store.root, now=lambda: at(15, 1))
    assert store.fold() == [months.number_of(2024, 12), months.number_of(2025, 1)]
    assert store.version() == version.plus("1-9", 1, 9)
    assert len(rows_of(store.events())) == 42


def test_newest_runs_read_their_months_and_no_more(store, spark, monkeypatch):
    store, _ = store
    store.fold()
    assert len(months.index(spark, store.ledger_path)) >= 11
    asked, read = [], months.read
    monkeypatch.setattr(months, "read", lambda spark, path, since, folded: asked.append(since) or read(spark, path, since, folded))
    for runs in (1, 4, 8, 100):
        store.recent(runs)
    last = months.index(spark, store.ledger_path)[-1].number
    assert asked[0] in (last, last + 1) and last - 2 <= asked[1] <= last
    assert last - 4 <= asked[2] < asked[1] and asked[3] is None
    plan = read(spark, store.ledger_path, last)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [") == 2 and "FileScan parquet" in plan


def test_a_fold_that_stopped_is_done_again(spark, monkeypatch):
    store = Store(spark, scratch_path(spark, "store"), now=lambda: at(6, 1))
    for month in (1, 2):
        begin(store, f"run{month}", month, 3)
    before = rows_of(store.events())
    with monkeypatch.context() as patched:
        patched.setattr(months, "small_frame", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.fold()
    assert rows_of(store.events()) == before and months.index(spark, store.ledger_path) == []
    assert len(store.fold()) == 2 and rows_of(store.events()) == before
    assert store.recent(1).columns == EVENT_SCHEMA.fieldNames()


def test_no_ledger_folds_to_nothing(spark):
    store = Store(spark, scratch_path(spark, "store"), now=lambda: at(6, 1))
    assert store.fold() == [] and store.events().count() == 0
    assert store.version() == Version() and store.recent(3).count() == 0
