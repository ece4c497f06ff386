import csv
import io
import os
import random

import pytest
from model import first_fault, read_import, to_date

from tidemark.sources import extracts
from tidemark.sources.extracts import IMPORT, REGISTRY

HEADER = "id_1|id_2|name|dob|vaccine_group_name|vaccination_date"


def put(folder, name, text, encoding="utf-8"):
    path = os.path.join(folder, name)
    with open(path, "wb") as out:
        out.write(text if isinstance(text, bytes) else text.encode(encoding))
    return path


def read(spark, folder, fmt):
    landing = extracts.read_landing(spark, [folder], fmt)
    by_name = lambda r: r["file"].rsplit("/", 1)[-1]
    records = {}
    for row in landing.records.collect():
        records.setdefault(by_name(row), set()).add(tuple(row)[:4])
    rejects = {by_name(r): (r["line_no"], r["reason"]) for r in landing.rejects.collect()}
    files = {by_name(r): r for r in landing.files.collect()}
    return records, rejects, files


def model_registry(text):
    """What a header-reading parser makes of a pipe file."""
    reader = csv.DictReader(io.StringIO(text), delimiter="|")
    names = ["id_1", "id_2", "vaccine_group_name", "vaccination_date"]
    if any(name not in (reader.fieldnames or []) for name in names):
        return None, (1, "missing_columns")
    records = []
    for number, row in enumerate(reader, start=2):
        fields = [row[name] for name in names]
        fault = "arity" if any(f is None for f in fields) else first_fault(fields)
        if fault:
            return None, (number, fault)
        records.append((*fields[:3], to_date(fields[3])))
    return set(records), None


CORPUS = {
    "plain.csv": f"{HEADER}\n00123|456|A B|2010-01-01|MMR|11/17/2024\n1|2|C|x|Flu|2024-01-05\n",
    "quoted.csv": f'{HEADER}\n1|2|"a|b"|d|"Flu ""x"""|2024-01-05\n"3"|"4|5"|n||Hep|2024-01-06\n',
    "swapped.csv": "vaccination_date|id_2|vaccine_group_name|extra|id_1\n2024-01-05|2|Flu|e|1\n",
    "quoted_header.csv": '"id_1"|"x|y"|"id_2"|vaccine_group_name|vaccination_date\n1|q|2|Flu|2024-01-05\n',
    "twice.csv": "id_1|id_2|vaccine_group_name|vaccination_date|id_1\n1|2|Flu|2024-01-05|9\n",
    "blank_lines.csv": f"{HEADER}\n\n1|2|n|d|Flu|2024-01-05\n\n\n3|2|n|d|Flu|someday\n",
    "missing.csv": "id_1|id_2|name|vaccination_date\n1|2|n|2024-01-05\n",
    "other_case.csv": HEADER.upper() + "\n1|2|n|d|Flu|2024-01-05\n",
    "leading_blank.csv": f"\n{HEADER}\n1|2|n|d|Flu|2024-01-05\n",
    "header_only.csv": f"{HEADER}\n",
    "header_no_end.csv": HEADER,
    "bad_date.csv": f"{HEADER}\n1|2|n|d|Flu|2024-13-05\n",
    "blank_id.csv": f"{HEADER}\n1|2|n|d|Flu|2024-01-05\n |2|n|d|Flu|2024-01-05\n",
    "nbsp_id.csv": f"{HEADER}\n1|  |n|d|Flu|2024-01-05\n",
    "unit_sep.csv": f"{HEADER}\n1|2|n|d|\x1c|2024-01-05\n",
    "empty_id.csv": f"{HEADER}\n|2|n|d|Flu|2024-01-05\n",
    "short.csv": f"{HEADER}\n1|2|n|d|Flu|2024-01-05\n1|2|n\n",
    "long.csv": f"{HEADER}\n1|2|n|d|Flu|2024-01-05|more|and|more\n",
    "two_faults.csv": f"{HEADER}\n|2|n|d|Flu|nope\n",
    "header_again.csv": f"{HEADER}\n1|2|n|d|Flu|2024-01-05\n{HEADER}\n3|2|n|d|Flu|bad\n",
    "spans.csv": f'{HEADER}\n1|2|"two\nlines"|d|Flu|2024-01-05\n3|4|n|d|"He\np"|2024-01-06\n',
    "spans_bad.csv": f'{HEADER}\n1|2|"two\nlines"|d|Flu|2024-01-05\n3|4|n|d|Hep|never\n',
    "inch.csv": f'{HEADER}\n1|2|5" pipe|d|Flu|2024-01-05\n',
    "windows.csv": f"{HEADER}\r\n1|2|n|d|Flu|2024-01-05\r\n3|4|n|d|Hep|2024-01-06\r\n",
    "spaces.csv": f"{HEADER}\n 1 | 2|n|d| Flu | 2024-01-05 \n",
}


def test_registry_files_read_as_a_header_parser_reads_them(spark, folder):
    for name, text in CORPUS.items():
        put(folder, name, text)
    records, rejects, files = read(spark, folder, REGISTRY)
    for name, text in CORPUS.items():
        # A file read as text has its line ends made one kind first.
        wanted, fault = model_registry(text.replace("\r\n", "\n"))
        assert rejects.get(name) == fault, name
        assert records.get(name, set()) == (wanted or set()), name
        assert files[name]["accepted"] == (fault is None), name
        assert files[name]["bytes"] == len(text.encode()), name


def test_rejects_carry_no_values(spark, folder):
    put(folder, "bad.csv", f"{HEADER}\nSECRET|2|n|d|Flu|nope\n")
    landing = extracts.read_landing(spark, [folder], REGISTRY)
    assert landing.rejects.columns == ["file", "line_no", "reason"]
    assert "SECRET" not in str(landing.rejects.collect())


def test_a_byte_order_mark_and_broken_text(spark, folder):
    put(folder, "mark.csv", f"﻿{HEADER}\n1|2|n|d|Flu|2024-01-05\n")
    put(folder, "latin.csv", f"{HEADER}\n1|2|Jos\xe9|d|Flu|2024-01-05\n", "latin-1")
    put(folder, "good.csv", f"{HEADER}\n9|2|José|d|Flu|2024-01-05\n")
    records, rejects, _ = read(spark, folder, REGISTRY)
    assert rejects == {"latin.csv": (2, "encoding")}
    assert set(records) == {"mark.csv", "good.csv"}


def test_all_files_rejected_leave_nothing(spark, folder):
    put(folder, "a.csv", "x|y\n1|2\n")
    records, rejects, files = read(spark, folder, REGISTRY)
    assert records == {} and rejects == {"a.csv": (1, "missing_columns")}
    assert not files["a.csv"]["accepted"]


IMPORTS = {
    "plain.csv": "123,456,MMR,01/15/2024\n1,2,Flu,2024-01-05\n",
    "extra.csv": "123,456,MMR,01/15/2024,extra,columns\n",
    "blank.csv": "123,456,MMR,01/15/2024\n\n , ,\n,,,\n\"\",\"\"\n3,4,Flu,1/5/2024\n",
    "few.csv": "123,456,MMR,01/15/2024\n123,456\n",
    "few_after_blank.csv": "\n\n123,456\n",
    "date.csv": "123,456,MMR,someday\n",
    "twice.csv": "123,456,MMR,01/15/2024\n123,456,MMR,2024-01-15\n",
    "late_text.csv": ",,,,x\n",
    "empty_date.csv": "1,2,MMR,,extra\n",
    "quotes.csv": '"a,b","say ""hi""",Flu,01/05/2024\n',
}


def test_import_files_read_as_the_model_reads_them(spark, folder):
    for name, text in IMPORTS.items():
        put(folder, name, text)
    records, rejects, _ = read(spark, folder, IMPORT)
    for name, text in IMPORTS.items():
        wanted, fault = read_import(text)
        assert rejects.get(name) == fault, name
        assert records.get(name, set()) == set(wanted or []), name


def test_files_sharing_a_record_combine_to_distinct_ones(spark, folder):
    put(folder, "a.csv", "1,2,MMR,01/15/2024\n3,4,Flu,01/16/2024\n")
    put(folder, "b.csv", "1,2,MMR,2024-01-15\n5,6,Flu,01/17/2024\n")
    put(folder, "bad.csv", "not,a\n")
    landing = extracts.read_landing(spark, [folder], IMPORT)
    assert extracts.combine(landing).count() == 3


@pytest.mark.parametrize("seed", range(2))
def test_line_numbers_hold_over_many_splits(spark, folder, seed):
    """Files cut into small splits still report the reader's line number."""
    rng = random.Random(seed)
    expected = {}
    for number in range(4):
        bad = rng.randrange(200, 3000)
        lines = [HEADER]
        for i in range(3000):
            date = "never" if i == bad or (i > bad and rng.random() < 0.01) else "2024-01-05"
            lines.append(f"{i}|S{number}|name {i}|d|Flu|{date}")
            if rng.random() < 0.05:
                lines.append("")
        put(folder, f"f{number}.csv", "\n".join(lines) + "\n")
        expected[f"f{number}.csv"] = (bad + 2, "date")
    put(folder, "good.csv", HEADER + "\n" + "1|2|n|d|Flu|2024-01-05\n" * 3000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records, rejects, _ = read(spark, folder, REGISTRY)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rejects == expected
    assert list(records) == ["good.csv"]


def test_missing_names_are_listed_in_order(spark, folder):
    put(folder, "a.csv", "name|vaccination_date|id_2\n")
    layout = extracts.audit(spark.read.text(folder), REGISTRY).first()["layout"]
    assert extracts.missing_columns(layout, REGISTRY) == ["id_1", "vaccine_group_name"]


def test_files_with_odd_names_are_found_again(spark, folder):
    names = ["a b.csv", "c[1].csv", "d{x}.csv", "e%20f.csv", "g,h.csv", "i*j.csv", "k\u00e9.csv",
             "l#m?.csv", "n+o.csv"]
    for number, name in enumerate(names):
        put(folder, name, f"{number},2,Flu,2024-01-05\n")
    put(folder, "z[9].csv", "1,2,Flu,never\n")
    landing = extracts.read_landing(spark, [folder], IMPORT)
    assert {r["id_1"] for r in landing.records.collect()} == {str(i) for i in range(len(names))}
    assert landing.rejects.count() == 1
