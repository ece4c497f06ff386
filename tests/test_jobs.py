import datetime as dt
import glob
import os
import shutil

import pytest
from model import read_import
from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.plans.store import Store
from tidemark.schema import KEY
from tidemark.sinks import export
from tidemark.sources import extracts
from tidemark.sources.extracts import IMPORT, REGISTRY
from tidemark.sources.master import MasterError, commit_event, committed, describe
from tidemark.streaming.landing import stream_landing

DAY = dt.date(2024, 2, 1)
HEADER = "id_1|id_2|vaccine_group_name|vaccination_date\n"


class Clock:
    """A clock that goes on by a minute each time it is read."""

    def __init__(self):
        self.at = dt.datetime(2024, 2, 1, 2, 9)

    def __call__(self):
        self.at += dt.timedelta(minutes=1)
        return self.at


@pytest.fixture
def store(spark, folder):
    return Store(spark, f"{folder}/store", Clock())


def land(folder, name, ids, source="S1"):
    path = os.path.join(folder, "landing", name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(HEADER + "".join(f"{i}|{source}|Flu|2024-01-05\n" for i in ids))
    return path


def ids(df):
    got = [r["id_1"] for r in df.collect()]
    assert len(got) == len(set(got))
    return {int(i) for i in got}


def types(store):
    rows = store.events().orderBy("at", "seq").collect()
    return [r["type"] for r in rows]


def read_csv(path):
    text = "".join(open(p).read() for p in sorted(glob.glob(f"{path}/part-*")))
    return text


def test_a_run_delivers_what_is_new_then_commits(store, folder):
    one = land(folder, "a.csv", range(100))
    first = jobs.run_incremental(store, [one], REGISTRY, DAY)
    assert (first.status, first.new_count, first.known_count) == ("success", 100, 0)
    assert types(store) == ["RunStarted", "RecordsFetched", "DiffComputed", "Delivered",
                            "MasterCommitted", "RunCompleted"]
    two = land(folder, "b.csv", range(90, 110))
    second = jobs.run_incremental(store, [two], REGISTRY, DAY + dt.timedelta(days=1))
    assert (second.status, second.new_count, second.known_count) == ("success", 10, 100)
    assert "2024-02-02_new_vaccinations.csv" in second.delivered_path
    records, fault = read_import(read_csv(second.delivered_path))
    assert fault is None and {int(r[0]) for r in records} == set(range(100, 110))
    assert ids(store.known()) == set(range(110))
    version = store.version()
    assert version.records == 110 and len(version.segments) == 2
    assert describe(store.known())[1:] == (version.records, version.digest)


def test_a_replay_finds_nothing_new_and_keeps_the_export(store, folder):
    path = land(folder, "a.csv", range(60))
    first = jobs.run_incremental(store, [path], REGISTRY, DAY)
    before = read_csv(first.delivered_path)
    again = jobs.run_incremental(store, [path], REGISTRY, DAY)
    assert (again.status, again.new_count, again.delivered_path) == ("success", 0, "")
    assert read_csv(first.delivered_path) == before
    assert types(store).count("Delivered") == 1
    assert len(store.version().segments) == 1


def test_a_flood_is_stopped_before_anything_is_delivered(store, folder):
    jobs.run_incremental(store, [land(folder, "a.csv", range(100))], REGISTRY, DAY)
    flood = land(folder, "b.csv", range(100, 400))
    out = jobs.run_incremental(store, [flood], REGISTRY, DAY)
    assert (out.status, out.step, out.error) == ("blocked", "diff_sanity", "SuspiciousDiffVolume")
    assert ids(store.known()) == set(range(100))
    assert types(store)[-1] == "RunFailed"
    # The archive copy is there for a look at what was stopped.
    assert glob.glob(f"{store.archive_path}/date=2024-02-01/fp=300-*")
    off = jobs.run_incremental(store, [flood], REGISTRY, DAY, fraction=None)
    assert off.status == "success" and store.version().records == 400


def test_a_failed_delivery_leaves_the_master_alone(store, folder, monkeypatch):
    jobs.run_incremental(store, [land(folder, "a.csv", range(100))], REGISTRY, DAY)
    before = store.version()

    def broken(*args, **kwargs):
        raise ConnectionError("the folder is away")

    path = land(folder, "b.csv", range(90, 110))
    with monkeypatch.context() as patch:
        patch.setattr(export, "write_diff", broken)
        with pytest.raises(ConnectionError):
            jobs.run_incremental(store, [path], REGISTRY, DAY)
    assert store.version() == before
    last = store.events().orderBy(F.desc("at"), F.desc("seq")).first()
    assert last["type"] == "RunFailed"
    assert last["data"] == {"step": "deliver_diff", "error": "ConnectionError"}
    # The same records are in the next run's diff.
    assert jobs.run_incremental(store, [path], REGISTRY, DAY).new_count == 10


def test_a_run_that_stopped_before_its_commit_is_made_good(store, folder, monkeypatch):
    path = land(folder, "a.csv", range(30))

    def broken(*args, **kwargs):
        raise OSError("out of space")

    with monkeypatch.context() as patch:
        patch.setattr(type(store.master), "write_segment", broken)
        with pytest.raises(OSError):
            jobs.run_incremental(store, [path], REGISTRY, DAY)
    assert store.version().records == 0
    again = jobs.run_incremental(store, [path], REGISTRY, DAY)
    # Delivered by the run before, with the same content: commit, then skip.
    assert again.status == "skipped" and again.delivered_path == ""
    assert types(store).count("Delivered") == 1
    assert ids(store.known()) == set(range(30))


def test_another_diff_of_the_same_day_is_delivered(store, folder):
    jobs.run_incremental(store, [land(folder, "a.csv", range(100))], REGISTRY, DAY)
    out = jobs.run_incremental(store, [land(folder, "b.csv", range(100, 110))], REGISTRY, DAY)
    assert out.status == "success" and out.delivered_path
    assert types(store).count("Delivered") == 2


def test_bad_and_missing_files_count_as_failures(store, folder):
    good = land(folder, "a.csv", range(10))
    bad = land(folder, "b.csv", [])
    with open(bad, "a") as out:
        out.write("1|S2|Flu|never\n")
    out = jobs.run_incremental(store, [good, bad], REGISTRY, DAY, expected_sources=3)
    assert (out.status, out.files_transformed, out.fetch_failures) == ("success", 1, 2)
    assert ids(store.known()) == set(range(10))


def test_all_files_bad_is_a_failure(store, folder):
    bad = land(folder, "b.csv", [])
    with open(bad, "a") as out:
        out.write("1|S2|Flu|never\n")
    out = jobs.run_incremental(store, [bad], REGISTRY, DAY)
    assert (out.status, out.error) == ("failed", "AllDownloadsFailed")


def test_empty_and_absent_files_are_no_success(store, folder):
    empty = land(folder, "e.csv", [])
    open(empty, "w").close()
    out = jobs.run_incremental(store, [empty], REGISTRY, DAY)
    assert (out.status, out.error, out.fetch_failures) == ("failed", "AllDownloadsFailed", 1)
    out = jobs.run_incremental(store, [f"{folder}/nowhere/*"], REGISTRY, DAY, expected_sources=2)
    assert (out.status, out.error, out.fetch_failures) == ("failed", "NoResultsStaged", 2)
    good = land(folder, "a.csv", range(10))
    out = jobs.run_incremental(store, [good, empty], REGISTRY, DAY)
    assert (out.status, out.files_transformed, out.fetch_failures) == ("success", 1, 1)


def test_a_source_that_was_away_is_not_delivered_again(store, folder):
    a, b = land(folder, "a.csv", range(10)), land(folder, "b.csv", range(10, 20), "S2")
    jobs.run_incremental(store, [a, b], REGISTRY, DAY)
    assert jobs.run_incremental(store, [a], REGISTRY, DAY).new_count == 0
    assert jobs.run_incremental(store, [a, b], REGISTRY, DAY).new_count == 0


def test_a_lost_master_fails_instead_of_delivering_everything(store, folder):
    path = land(folder, "a.csv", range(10))
    jobs.run_incremental(store, [path], REGISTRY, DAY)
    os.rename(f"{store.root}/master", f"{store.root}/elsewhere")
    with pytest.raises(MasterError):
        jobs.run_incremental(store, [path], REGISTRY, DAY)
    assert types(store)[-1] == "RunFailed"


def test_a_segment_without_its_event_is_not_read(store, frame):
    part = frame([("1", "S1", "Flu", "2024-01-05")])
    segment, _, _ = describe(part)
    store.master.write_segment(part, segment)
    assert store.known().count() == 0


def test_the_master_is_read_without_a_shuffle(spark, store, folder):
    jobs.run_incremental(store, [land(folder, "a.csv", range(50))], REGISTRY, DAY)
    known = store.known()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        probe = spark.read.schema(known.schema).parquet(f"{store.archive_path}/*/*")
        joined = known.join(probe.hint("shuffle_hash"), KEY, "left_semi")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Sort [" not in plan


def test_rebaseline_exports_everything_in_bounded_files(store, folder):
    assert jobs.run_rebaseline(store, DAY).error == "EmptyMaster"
    jobs.run_incremental(store, [land(folder, "a.csv", range(100, 125))], REGISTRY, DAY)
    out = jobs.run_rebaseline(store, DAY, size=10)
    assert (out.status, out.files_transformed, out.known_count) == ("success", 3, 25)
    names = sorted(os.listdir(out.delivered_path))
    names = [n.split("=", 1)[1] for n in names if n.startswith("file_name=")]
    assert names == [f"2024-02-01_rebaseline_0{i}-of-03.csv" for i in (1, 2, 3)]
    texts = [read_csv(f"{out.delivered_path}/file_name={n}") for n in names]
    assert [t.count("\n") for t in texts] == [10, 10, 5]
    assert "".join(texts) == "".join(f"{i},S1,Flu,01/05/2024\n" for i in range(100, 125))
    delivered = store.events().filter("type = 'Delivered' and data.file_name like '%rebaseline%'")
    assert sorted(r["data"]["file_name"] for r in delivered.collect()) == names


def test_reconciliation_confirms_files_that_are_gone(store, folder):
    out = jobs.run_incremental(store, [land(folder, "a.csv", range(5))], REGISTRY, DAY)
    jobs.run_incremental(store, [land(folder, "b.csv", range(5, 9))], REGISTRY, DAY + dt.timedelta(days=1))
    status = jobs.run_reconciliation(store, DAY + dt.timedelta(days=20))
    assert {r["status"] for r in status.collect()} == {"overdue"}
    shutil.rmtree(out.delivered_path)
    status = jobs.run_reconciliation(store, DAY + dt.timedelta(days=20))
    assert {r["file_name"][:10]: r["status"] for r in status.collect()} == {
        "2024-02-01": "imported", "2024-02-02": "overdue"}
    made = store.events().filter("type = 'ImportConfirmed'").collect()
    assert [r["data"]["file_name"] for r in made] == ["2024-02-01_new_vaccinations.csv"]
    jobs.run_reconciliation(store, DAY + dt.timedelta(days=20))
    assert types(store).count("ImportConfirmed") == 1


def test_two_deliveries_of_one_day_are_told_apart(store, folder):
    out = [jobs.run_incremental(store, [land(folder, f"{i}.csv", range(10 * i, 10 * i + 5))], REGISTRY, DAY)
           for i in range(3)]
    shutil.rmtree(out[0].delivered_path)
    # A backfill's day is not the ledger's clock.
    status = jobs.run_reconciliation(store, dt.date(2023, 5, 1)).collect()
    assert sorted(r["status"] for r in status) == ["awaiting", "awaiting", "imported"]
    last = jobs.run_reconciliation(store, DAY + dt.timedelta(days=9)).collect()
    assert [r["status"] for r in last] == ["overdue", "overdue"]


def test_of_two_commits_on_one_version_the_first_counts(store, folder, frame):
    jobs.run_incremental(store, [land(folder, "a.csv", range(20))], REGISTRY, DAY)
    base = store.version()
    for run, part in (("one", range(20, 30)), ("two", range(25, 35))):
        rows = frame([(str(i), "S1", "Flu", "2024-01-05") for i in part])
        segment, count, digest = describe(rows)
        store.master.write_segment(rows, segment)
        event = commit_event(base, base.plus(segment, count, digest), segment)
        store.run_ledger(run).append(event, required=True)
    assert ids(store.known()) == set(range(30)) and store.version().records == 30
    again = jobs.run_incremental(store, [land(folder, "b.csv", range(25, 35))], REGISTRY, DAY)
    assert again.new_count == 5 and ids(store.known()) == set(range(35))
    jobs.compact(store)
    assert len(store.version().segments) == 1 and ids(store.known()) == set(range(35))


def test_a_rerun_of_a_rebaseline_writes_nothing(store, folder):
    jobs.run_incremental(store, [land(folder, "a.csv", range(25))], REGISTRY, DAY)
    first = jobs.run_rebaseline(store, DAY, size=10)
    again = jobs.run_rebaseline(store, DAY, size=10)
    assert (first.status, again.status) == ("success", "skipped")
    assert again.delivered_path == first.delivered_path
    assert types(store).count("Delivered") == 4


def test_a_landing_the_gate_stops_comes_again(store, folder):
    def go(fraction):
        stream_landing(store, f"{folder}/landing", f"{folder}/checkpoint", REGISTRY, DAY,
                       fraction=fraction).awaitTermination()

    land(folder, "a.csv", range(100))
    go(0.2)
    land(folder, "b.csv", range(100, 300))
    with pytest.raises(Exception, match="SuspiciousDiffVolume"):
        go(0.2)
    assert ids(store.known()) == set(range(100))
    go(None)
    assert ids(store.known()) == set(range(300))


def test_a_listing_that_fails_stops_nothing(store, folder, monkeypatch):
    jobs.run_incremental(store, [land(folder, "a.csv", range(5))], REGISTRY, DAY)

    def broken(*args):
        raise ConnectionError

    monkeypatch.setattr(jobs.files, "folder_names", broken)
    assert jobs.run_reconciliation(store, DAY) is None


def test_status_and_compaction(store, folder):
    for day, part in enumerate([range(50), range(40, 60), range(55, 65)]):
        path = land(folder, f"{day}.csv", part)
        jobs.run_incremental(store, [path], REGISTRY, DAY + dt.timedelta(days=day))
    before = store.version()
    assert len(before.segments) == 3
    jobs.compact(store)
    after = store.version()
    assert (after.records, after.digest) == (before.records, before.digest)
    assert len(after.segments) == 1
    assert ids(store.known()) == set(range(65))
    jobs.run_incremental(store, [land(folder, "9.csv", range(60, 70))], REGISTRY, DAY)
    assert ids(store.known()) == set(range(70))
    assert len(store.version().segments) == 2
    rows = jobs.status(store, DAY).collect()
    assert [r["outcome"] for r in rows] == ["RunCompleted"] * 5


def test_an_export_reads_back_as_it_was(spark, frame, folder):
    rows = [("00123", "a,b", 'say "hi"', "2024-11-17"), ("1", " x ", "Flu", "2024-01-05")]
    records = frame(rows)
    export.write_lines(records, f"{folder}/out")
    landing = extracts.read_landing(spark, [f"{folder}/out/part-*"], IMPORT)
    got = {tuple(r)[:3] + (str(r[3]),) for r in extracts.combine(landing).collect()}
    assert got == set(rows)
    export.write_lines(records.limit(0), f"{folder}/none")
    assert read_csv(f"{folder}/none") == ""


def test_the_stream_takes_each_file_once(store, folder):
    def go():
        query = stream_landing(store, f"{folder}/landing", f"{folder}/checkpoint", REGISTRY, DAY,
                               fraction=None)
        query.awaitTermination()

    land(folder, "a.csv", range(20))
    go()
    go()
    assert types(store).count("RunStarted") == 1
    # A file that comes late is new, whatever its dates say.
    land(folder, "b.csv", range(15, 30), "S1")
    open(os.path.join(folder, "landing", "empty.csv"), "w").close()
    go()
    assert ids(store.known()) == set(range(30))
    assert types(store).count("RunStarted") == 2


def test_no_commits_is_the_empty_version(spark, store):
    assert committed(store.events()).segments == ()
    assert store.known().count() == 0
