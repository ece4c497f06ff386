import datetime as dt
import hashlib
import sys

import pytest
from model import render, to_date
from pyspark.sql import functions as F

from tidemark.functions import digest, names, text
from tidemark.functions.dates import file_age, flexible_date, month_window, period
from tidemark.functions.events import check_fields, detail, event, payload

DATES = [
    "2024-11-17", "11/17/2024", "1/5/2024", "01/05/2024", "20241117", " 2024-11-17 ",
    "2024-1-5", "2024-11-17T00:00:00", "02/30/2024", "11/17/24", "11/17/20245", "",
    "someday", "2024-W46-7", "2024W467", "2024-W46", "2020-W53-5", "2021-W53-1", "2024-W00-1",
    "02/29/2024", "02/29/2023", "13/01/2024", "00/10/2024", "0000-01-01", "2024-02-30",
    "01/ 5/2024", "1/5/2024 ", " 2024-11-17　", "011/17/2024", "2024/11/17",
    "17-11-2024", "2024-W46-8", "2024-W467", "9999-12-31", "12/31/9999", "0999-01-01",
]


def test_dates_read_as_the_model_reads_them(spark):
    rows = spark.createDataFrame([(i, one) for i, one in enumerate(DATES)], "i int, t string")
    got = {r["t"]: r["d"] for r in rows.select("t", flexible_date(F.col("t")).alias("d")).collect()}
    assert got == {one: to_date(one) for one in DATES}


def test_blank_and_strip_know_every_white_space_character(spark):
    spaces = [chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    values = ["", "x", " x ", "​", "a b", *spaces, *[s + "x" + s for s in spaces]]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = rows.select("v", text.is_blank(F.col("v")).alias("b"), text.strip(F.col("v")).alias("s"))
    for row in got.collect():
        assert row["b"] == (not row["v"].strip())
        assert row["s"] == row["v"].strip()
    assert spark.range(1).select(text.is_blank(F.lit(None).cast("string"))).first()[0]


def test_lines_are_quoted_only_where_needed(spark, frame):
    rows = [
        ("00123", "456", "COVID-19", "2024-11-17"),
        ("a,b", 'say "hi"', "two\nlines", "2024-01-05"),
        (" lead", "trail ", "|pipe", "0999-01-05"),
        ("c\rr", "'", "#", "2024-02-29"),
    ]
    made = frame(rows).select(digest.record_line().alias("v")).collect()
    expected = []
    for id_1, id_2, group, day in rows:
        one = render([(id_1, id_2, group, dt.date.fromisoformat(day))])
        # The platform may leave years below 1000 unpadded; four digits here.
        expected.append(one[:-1].replace("01/05/999", "01/05/0999"))
    assert sorted(r["v"] for r in made) == sorted(expected)


def test_line_digest_is_the_head_of_sha256(spark):
    got = spark.range(1).select(digest.line_digest(F.lit("1,2,MMR,01/15/2024"))).first()[0]
    assert int(got) == int(hashlib.sha256(b"1,2,MMR,01/15/2024").hexdigest()[:15], 16)


def test_fingerprints_of_disjoint_sets_add_up(spark, frame):
    left = frame([(str(i), "a", "Flu", "2024-01-01") for i in range(20)])
    right = frame([(str(i), "b", "Flu", "2024-01-01") for i in range(30)])
    one, two = digest.fingerprint(left).first(), digest.fingerprint(right).first()
    both = digest.fingerprint(right.unionByName(left).repartition(5)).first()
    assert both["records"] == 50
    assert both["fingerprint"] == one["fingerprint"] + two["fingerprint"]
    assert digest.fingerprint(left.limit(0)).first()["fingerprint"] == 0


def test_odd_quotes_marks_lines_that_stay_open(spark):
    cases = {"a|b": False, '"a"|b': False, '"a|b': True, '"a""b"|c': False, '5" pipe': True, "": False}
    rows = spark.createDataFrame([(c,) for c in cases], "v string")
    got = {r["v"]: r["o"] for r in rows.select("v", text.odd_quotes(F.col("v")).alias("o")).collect()}
    assert got == cases


def test_names(spark):
    row = spark.range(1).select(
        names.landing_name(F.lit("Lake High School"), F.lit("20240131_020900"), F.lit("0a1b2c3d")),
        names.transformed_name(F.lit("/x/vaccinations_A.csv")),
        names.chunk_name(F.lit("2024-01-31"), F.lit(3), F.lit(12)),
        names.chunk_name(F.lit("2024-01-31"), F.lit(103), F.lit(1200)),
        names.event_name(F.lit(7), F.lit("Delivered")),
    ).first()
    assert list(row) == [
        "vaccinations_Lake_High_School_20240131_020900_0a1b2c3d.csv",
        "transformed_vaccinations_A.csv",
        "2024-01-31_rebaseline_03-of-12.csv",
        "2024-01-31_rebaseline_103-of-1200.csv",
        "007_Delivered.json",
    ]
    assert names.diff_name(dt.date(2024, 1, 5)) == "2024-01-05_new_vaccinations.csv"
    run = names.new_run_id("run", dt.datetime(2024, 1, 5, 2, 9, 0))
    assert run.startswith("run_20240105_020900_") and len(run) == 28


def test_months_and_periods(spark):
    assert month_window(dt.date(2024, 1, 15)) == [(2024, 1), (2023, 12)]
    assert month_window(dt.date(2024, 3, 31), 3) == [(2024, 3), (2024, 2), (2024, 1)]
    assert spark.range(1).select(period(F.lit(dt.date(2024, 1, 5)))).first()[0] == "2024-01"


def test_file_age(spark):
    cases = {
        "2024-01-24_new_vaccinations.csv": 7,
        "2024-01-31": 0,
        "notes.csv": None,
        "2024-02-30_x.csv": None,
        "": None,
    }
    rows = spark.createDataFrame([(c,) for c in cases], "v string")
    age = file_age(F.col("v"), F.lit(dt.date(2024, 1, 31)))
    assert {r["v"]: r["a"] for r in rows.select("v", age.alias("a")).collect()} == cases


def test_event_payloads_are_text_and_keep_their_shape(spark):
    made = event("Delivered", file_name=F.lit("f"), target=F.lit("drive"), remote_id=F.lit(None))
    row = spark.range(1).select(made.alias("e")).first()["e"]
    assert row["type"] == "Delivered"
    assert row["data"] == {"file_name": "f", "target": "drive", "remote_id": ""}
    summary = payload("RunCompleted", schools=F.lit(8), new_records=F.lit(648))
    assert spark.range(1).select(detail(summary)).first()[0] == "schools=8, new_records=648"
    with pytest.raises(ValueError):
        check_fields("RunFailed", ["step", "message"])
