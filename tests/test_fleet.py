"""Runs of many districts in one plan, by schools' names."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import districts
from tidemark.functions.digest import digest_sum, record_line
from tidemark.operators import sources
from tidemark.plans import fleet as fleet_plan
from tidemark.plans.fleet import Fleet, district_of, run_fleet, versions
from tidemark.session import scratch_path
from tidemark.sources.extracts import REGISTRY

HEADER = "id_1|id_2|vaccine_group_name|vaccination_date\n"
DAY = dt.date(2024, 1, 31)


def dimension(spark, districts):
    """Two schools for each district: ``D0-a``, ``D0-b``, ..."""
    docs = [({"iddis": d}, {"s3_upload_host": "h"},
             [{"name": s, "id": s, "classification": "N", "email": "", "bulk_query_file": f"{s}.txt"}
              for s in (f"{d}-a", f"{d}-b")]) for d in districts]
    config = spark.createDataFrame(docs, "district struct<iddis string>, api struct<s3_upload_host string>, "
                                         "schools array<struct<name string, id string, classification string, "
                                         "email string, bulk_query_file string>>")
    entry = '[{"uploadDateTime": 2, "fullVaccineFileUrl": "https://h/%s.csv"}, {"uploadDateTime": 1, "fullVaccineFileUrl": "x"}]'
    listed = [(d, s, entry % s) for d in districts for s in (f"{d}-a", f"{d}-b")]
    listings = spark.createDataFrame(listed, "district_id string, school_id string, body string")
    rosters = spark.createDataFrame([(f"{d}-{s}.txt", "r") for d in districts for s in "ab"], "path string, digest string")
    return config, listings, rosters


def land(folder, name, records):
    path = os.path.join(folder, name)
    os.makedirs(path)
    for school, rows in records.items():
        with open(os.path.join(path, f"{school}.csv"), "w") as out:
            out.write(HEADER + "".join(f"{i}|{school}|Flu|2024-01-05\n" for i in rows))
    return [path]


def outcomes(frame):
    return {r["district_id"]: r for r in frame.collect()}


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    """Three districts: one is stopped by the gate, one has a bad file and a file missing."""
    folder = str(tmp_path_factory.mktemp("fleet"))
    fleet = Fleet(spark, scratch_path(spark, "fleet"))
    dims = dimension(spark, ["D0", "D1", "D2"])
    first = land(folder, "first", {"D0-a": range(10), "D0-b": range(10), "D1-a": range(10), "D2-a": range(5)})
    one = outcomes(run_fleet(fleet, *dims, first, REGISTRY, dt.date(2024, 1, 1), fraction=None, run_id="one"))
    second = land(folder, "second", {"D0-a": range(5, 20), "D0-b": range(3), "D1-a": range(100, 200),
                                     "D2-a": ["", 7], "stray": range(3)})
    two = outcomes(run_fleet(fleet, *dims, second, REGISTRY, DAY, run_id="two"))
    return fleet, dims, one, two, second


def test_each_district_has_its_own_outcome(ran):
    _, _, one, two, _ = ran
    assert {d: (r["status"], r["new_count"], r["known_count"]) for d, r in one.items()} == {
        "D0": ("success", 20, 0), "D1": ("success", 10, 0), "D2": ("success", 5, 0)}
    assert {d: (r["status"], r["step"], r["new_count"], r["known_count"], r["fetch_failures"]) for d, r in two.items()} == {
        "D0": ("success", "", 10, 20, 0), "D1": ("blocked", "diff_sanity", 100, 10, 1),
        "D2": ("failed", "fetch", 0, 5, 2)}


def test_only_what_passed_is_delivered_and_committed(ran, spark):
    fleet = ran[0]
    held = fleet.known().groupBy("district_id").count().collect()
    assert {r["district_id"]: r["count"] for r in held} == {"D0": 30, "D1": 10, "D2": 5}
    sent = spark.read.text(fleet.delivery_path).where(F.col("date") == DAY).collect()
    assert {r["district_id"] for r in sent} == {"D0"}
    assert sorted(r["value"] for r in sent) == sorted(f"{i},D0-a,Flu,01/05/2024" for i in range(10, 20))
    archived = spark.read.parquet(f"{fleet.archive_path}/date={DAY}").groupBy("district_id").count().collect()
    assert {r["district_id"]: r["count"] for r in archived} == {"D0": 10, "D1": 100}


def test_events_name_every_school(ran):
    rows = ran[0].events().where(F.col("run_id").startswith("two")).orderBy("run_id", "seq").collect()
    told = {}
    for r in rows:
        told.setdefault(r["run_id"].split("@")[1], []).append((r["type"], r["data"].get("school_id"), r["data"].get("error")))
    assert told["D0"] == [
        ("RunStarted", None, None), ("QuerySubmitted", "D0-a", None), ("QuerySubmitted", "D0-b", None),
        ("RecordsFetched", "D0-a", None), ("RecordsFetched", "D0-b", None), ("DiffComputed", None, None),
        ("Delivered", None, None), ("MasterCommitted", None, None), ("RunCompleted", None, None)]
    assert [e for e in told["D2"] if e[2]] == [
        ("SourceFailed", "D2-a", "FileRejected:id_1"), ("SourceFailed", "D2-b", "ResultNotLanded"),
        ("RunFailed", None, "AllDownloadsFailed")]
    assert told["D1"][-1] == ("RunFailed", None, "SuspiciousDiffVolume")
    assert [r["seq"] for r in rows if r["run_id"] == "two@D0"] == list(range(1, 10))


def test_a_run_that_stopped_before_its_commit_is_run_again(ran, spark, monkeypatch):
    fleet, dims, _, _, second = ran

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Fleet, "write_segment", stop)
        with pytest.raises(RuntimeError, match="lost"):
            run_fleet(fleet, *dims, second, REGISTRY, DAY, fraction=None, run_id="three")
    last = fleet.events().where("run_id = 'three@D1'").orderBy(F.desc("seq")).first()
    assert (last["type"], last["data"]["step"]) == ("RunFailed", "commit_master")
    again = outcomes(run_fleet(fleet, *dims, second, REGISTRY, DAY, fraction=None, run_id="four"))
    # Delivered by the run that stopped, so committed now and not sent twice.
    assert (again["D1"]["status"], again["D1"]["new_count"]) == ("skipped", 100)
    assert fleet.known().where("district_id = 'D1'").count() == 110
    assert outcomes(run_fleet(fleet, *dims, second, REGISTRY, DAY, fraction=None))["D1"]["new_count"] == 0
    newest = {r["district_id"]: r["known_count"] for r in versions(fleet.commits()).collect()}
    assert newest == {"D0": 30, "D1": 110, "D2": 5}


def test_jobs_do_not_grow_with_districts(spark, folder):
    context, jobs = spark.sparkContext, {}
    for n in (2, 15):
        names = [f"E{i}" for i in range(n)]
        paths = land(folder, f"of{n}", {f"{d}-{s}": range(4) for d in names for s in "ab"})
        context.setJobGroup(f"fleet-{n}", "count")
        fleet = Fleet(spark, scratch_path(spark, "fleet"))
        done = outcomes(run_fleet(fleet, *dimension(spark, names), paths, REGISTRY, DAY))
        jobs[n] = len(context.statusTracker().getJobIdsForGroup(f"fleet-{n}"))
        assert {r["status"] for r in done.values()} == {"success"} and len(done) == n
    context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs[15] <= jobs[2] + 2, jobs


def test_parts_of_an_extract_are_taken_together(spark):
    files = spark.createDataFrame(
        [("/x/file_name=a.csv/p0", True, 5, "h0"), ("/x/file_name=a.csv/p1", False, 6, "h1"), ("/x/b.csv", True, 1, "h2")],
        "file string, accepted boolean, bytes long, content_hash string")
    rejects = spark.createDataFrame([("/x/file_name=a.csv/p1", 2, "date")], "file string, line_no long, reason string")
    got = {r["name"]: (r["accepted"], r["byte_size"], r["content_hash"], r["reason"])
           for r in sources.landed(files, rejects).collect()}
    assert got == {"a.csv": (False, 11, "h0+h1", "date"), "b.csv": (True, 1, "h2", None)}


def test_districts_are_told_from_run_ids(spark):
    assert spark.range(1).select(district_of(F.lit("run@S 1"))).first()[0] == "S 1"


def test_a_content_name_adds_up_from_its_districts(spark):
    """The name of all records, a null district's too, from one row per district."""
    rows = [("D0", "1"), ("D0", "2"), ("D1", "1"), (None, "3")]
    new = spark.createDataFrame(rows, "district_id string, id_1 string").withColumns(
        {"id_2": F.lit("S"), "vaccine_group": F.lit("Flu"), "vaccination_date": F.lit("2024-01-05").cast("date")}
    )
    line = F.concat_ws("\n", "district_id", record_line())
    whole = new.agg(digest_sum(line).cast("string").alias("d")).first()["d"]
    added = fleet_plan._added(new)
    assert fleet_plan._content_name(added) == (f"4-{whole}", 4)
    assert fleet_plan._content_name(added.limit(0)) == ("0-0", 0)


def test_records_of_all_landings_are_joined_once(spark):
    rows = districts._records(spark, "/root/testdata/sf0.001")
    assert all("/records-" in name for name in rows.inputFiles())
