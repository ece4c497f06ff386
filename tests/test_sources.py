import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import exchange
from tidemark.operators import coverage
from tidemark.sources import dimension, extracts, files


def config(**changes):
    school = {"name": "Lake High", "id": "1", "classification": "N", "email": "a@b",
              "bulk_query_file": "rosters/1.csv"}
    whole = {
        "district": {"iddis": "0042"},
        "api": {"auth_base_url": "u", "s3_upload_host": "h"},
        "schools": [school, {**school, "name": "Hill", "id": "2"}],
    }
    return {**whole, **changes}


def put(folder, name, body):
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write(body)
    return path


def test_schools_and_district_from_configuration(spark, folder):
    path = put(folder, "config.json", json.dumps(config(), indent=2))
    read = dimension.read_config(spark, path)
    got = [tuple(r) for r in dimension.schools(read).orderBy("school_id").collect()]
    assert got[0] == ("0042", "Lake High", "N", "1", "a@b", "rosters/1.csv")
    assert [r[1] for r in got] == ["Lake High", "Hill"]
    assert tuple(dimension.district(read).first()) == ("0042", "h")


def test_a_missing_upload_identity_fails(spark, folder):
    path = put(folder, "config.json", json.dumps(config(district={})))
    with pytest.raises(Exception, match="missing configuration"):
        dimension.district(dimension.read_config(spark, path)).collect()


def test_latest_listing_entry_goes_by_upload_time(spark):
    def entry(day, url):
        at = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc).timestamp() * 1000
        return {"id": day, "schoolId": "1", "uploadDateTime": int(at), "fullVaccineFileUrl": url,
                "s3FileName": "ignored"}

    bodies = [
        ("1", json.dumps([entry(3, "late"), entry(1, "early")])),
        ("2", "[]"),
        ("4", json.dumps([entry(2, "first"), entry(2, "second")])),
    ]
    listings = spark.createDataFrame(bodies, "school_id string, body string")
    entries = dimension.listing_entries(listings, "school_id", "body")
    latest = coverage.latest(entries, ["school_id"], "url", ["uploaded", "position"])
    schools = spark.createDataFrame([(s,) for s in "1234"], "school_id string")
    covered = coverage.with_latest(schools, latest, "school_id", "url")
    got = {r["school_id"]: (r["url"], r["staged"]) for r in covered.collect()}
    assert got == {"1": ("late", True), "2": (None, False), "3": (None, False), "4": ("second", True)}
    assert tuple(coverage.staged_counts(covered).first()) == (4, 2, 2)


def test_files_digest_and_listing(spark, folder):
    body = "a,b\nc\n"
    put(folder, "one.csv", body)
    put(folder, "empty.csv", "")
    row = files.file_sha256(spark, folder).filter(F.col("length") > 0).first()
    assert row["sha256"] == hashlib.sha256(body.encode()).hexdigest()
    assert row["length"] == len(body)
    listed = files.list_files(spark, folder)
    assert "one.csv" in {r["file_name"] for r in listed.collect()}
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_rosters_match_by_path_and_gaps_show(spark):
    schools = spark.createDataFrame([("1", "r/1.csv"), ("2", "r/2.csv")], "school_id string, query_file string")
    found = spark.createDataFrame([("r/1.csv", "d")], "path string, sha256 string")
    got = {r["school_id"]: r["sha256"] for r in coverage.with_files(schools, found, F.col("query_file")).collect()}
    assert got == {"1": "d", "2": None}
    sent = spark.createDataFrame([("1",), ("1",)], "school_id string")
    assert [r["school_id"] for r in coverage.not_submitted(schools, sent, ["school_id"]).collect()] == ["2"]


def test_files_of_all_sizes_have_one_digest(spark, folder, monkeypatch):
    put(folder, "small.csv", "a,b\n")
    put(folder, "la rge+1.csv", "1,2,Flu,01/05/2024\n3,4,Flu,01/05/2024\n")
    put(folder, "none.csv", "")
    got = {r["path"].rsplit("/", 1)[-1]: r for r in files.file_digests(spark, folder).collect()}
    head = lambda line: int(hashlib.sha256(line).hexdigest()[:15], 16)
    large = head(b"1,2,Flu,01/05/2024") + head(b"3,4,Flu,01/05/2024")
    assert {n: (r["length"], r["line_digest"]) for n, r in got.items()} == {
        "la rge+1.csv": (38, str(large)), "small.csv": (4, str(head(b"a,b")))}
    assert files.count_files(spark, [folder]) == 3
    monkeypatch.setattr(files, "WHOLE_FILE_BYTES", 10)
    with pytest.raises(Exception, match="too large for one task"):
        files.file_sha256(spark, folder).collect()


def test_a_landing_that_is_listed_already_is_not_listed_again(spark, folder):
    put(folder, "one.csv", "id_1|id_2|vaccine_group_name|vaccination_date\n1|S|Flu|2024-01-05\n")
    text = spark.read.text([folder])
    nowhere = [f"{folder}/nowhere"]
    assert files.count_files(spark, nowhere, text) == 1
    landing = extracts.read_landing(spark, nowhere, extracts.REGISTRY, text)
    assert [r["id_1"] for r in landing.records.collect()] == ["1"]


def test_files_of_a_jobs_landing_hold_half_a_million_events(spark):
    """Events 40,000 apart: by the small parts of the extract queries each would have a file."""
    rows = spark.range(10).select(
        F.lit("1").alias("id_1"), F.lit("S001").alias("id_2"), F.lit("Flu").alias("vaccine_group"),
        F.lit("2024-01-05").cast("date").alias("vaccination_date"), (F.col("id") * 40_000).alias("event_id"),
    )
    path = exchange._land(spark, "", rows)
    assert files.count_files(spark, [f"{path}/*/*/part-*"]) == 1
    landing = extracts.read_landing(spark, [f"{path}/*/*/part-*"], extracts.REGISTRY)
    assert landing.records.count() == 10
