"""Records over line ends in files cut into many splits, and digests that know order."""

import csv
import hashlib
import io
import random
from contextlib import contextmanager

import pytest
from model import read_import
from test_extracts import HEADER, model_registry, put, read

from tidemark.functions import rolling
from tidemark.sources import extracts, files, spans
from tidemark.sources.extracts import IMPORT, REGISTRY


@contextmanager
def splits_of(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def field(rng):
    parts = ["plain", 'said "so"', "two\nlines", "a|b,c", "x" * 90, "\n\n", '"', 'end"\n"begin', "", '""\n', "é\n"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))


def written(rng, rows, separator, bad=()):
    out = io.StringIO()
    writer = csv.writer(out, delimiter=separator, lineterminator="\n")
    for i in range(rows):
        day = "never\never" if i in bad else "2024-01-05"
        name = field(rng) if rng.random() < 0.5 else "name"
        row = [f"{i}", "S1", f"n{name}", "d", "Flu" + field(rng), day]
        writer.writerow(row if separator == "|" else [row[0], row[1], row[4], row[5], row[2]])
        if rng.random() < 0.1:
            out.write("\n")
    return out.getvalue()


@pytest.mark.parametrize("size", [300, 1 << 20])
def test_registry_records_are_the_model_s_in_any_splits(spark, folder, size):
    rng = random.Random(size)
    texts = {f"good{i}.csv": HEADER + "\n" + written(rng, 120, "|") for i in range(2)}
    texts["bad.csv"] = HEADER + "\n" + written(rng, 120, "|", bad=(77, 90))
    texts["plain.csv"] = HEADER + "\n" + "1|2|n|d|Flu|2024-01-05\n" * 50
    texts["inches.csv"] = HEADER + "\n" + '1|2|5" pipe|d|6" x|2024-01-05\n2|2|"a\nb"|d|7"|2024-01-05\n' * 20
    for name, text in texts.items():
        put(folder, name, text)
    with splits_of(spark, size):
        records, rejects, _ = read(spark, folder, REGISTRY)
    for name, text in texts.items():
        wanted, fault = model_registry(text)
        assert rejects.get(name) == fault, name
        assert records.get(name, set()) == (wanted or set()), name


@pytest.mark.parametrize("size", [300, 1 << 20])
def test_import_records_are_the_model_s_in_any_splits(spark, folder, size):
    rng = random.Random(size)
    texts = {"good.csv": written(rng, 100, ","), "bad.csv": written(rng, 100, ",", bad=(60,)),
             "tail.csv": '1,2,"Flu\n\n', "short.csv": '1,2,Flu,2024-01-05\n3,"4\n5",Flu\n'}
    for name, text in texts.items():
        put(folder, name, text)
    with splits_of(spark, size):
        records, rejects, _ = read(spark, folder, IMPORT)
    for name, text in texts.items():
        wanted, fault = read_import(text)
        assert rejects.get(name) == fault, name
        assert records.get(name, set()) == set(wanted or []), name


def test_many_tasks_read_one_file(spark, folder):
    put(folder, "large.csv", HEADER + "\n" + written(random.Random(3), 400, "|"))
    with splits_of(spark, 1000):
        lines = extracts._lines(spark.read.text(folder))
        assert lines.rdd.getNumPartitions() > 20
        found = spans.records(lines, "|", False)
        per_block = found.groupBy("block").agg({"place": "max", "value": "count"}).collect()
    assert len(per_block) > 20 and sum(r["count(value)"] for r in per_block) == 401
    assert all(r["max(place)"] == r["count(value)"] for r in per_block)


def test_a_quote_never_closed_rejects_its_file_without_being_put_together(spark, folder, monkeypatch):
    monkeypatch.setattr(spans, "MOST_BYTES", 2000)
    put(folder, "open.csv", f'{HEADER}\n1|2|n|d|Flu|2024-01-05\n3|2|"n|d|Flu|2024-01-05\n' + "4|2|n|d|Flu|2024-01-05\n" * 300)
    put(folder, "good.csv", f'{HEADER}\n1|2|"n\n"|d|Flu|2024-01-05\n')
    with splits_of(spark, 700):
        records, rejects, _ = read(spark, folder, REGISTRY)
    assert rejects == {"open.csv": (3, "oversized")} and set(records) == {"good.csv"}


def test_states_at_line_ends_are_a_reader_s(spark):
    lines = ['a', '"a', 'a"', '"a"', '"a""', '""', '"""', '""""', '5"|"x', '5"|"x"', '"a"b"|"', '|"', '"|', '"a"|"b', '',
             '"a" "b', 'x|""|"y""']
    rows = spark.createDataFrame([(line,) for line in lines], "value string")
    got = {r["value"]: (r["out"], r["in"]) for r in rows.select(
        "value", spans._ends_inside(rows["value"], False, "|").alias("out"),
        spans._ends_inside(rows["value"], True, "|").alias("in")).collect()}

    def ends_inside(text):
        # A line more is a record more, unless a quote is still open.
        return len(list(csv.reader(io.StringIO(text + "\nz"), delimiter="|"))) == 1

    for line in lines:
        want = (ends_inside(line) if line else False, ends_inside('"' + "\n" + line))
        assert got[line] == want, line


def test_headers_of_any_width(spark, folder):
    wide = "|".join(["id_1", "id_2", "vaccine_group_name", "vaccination_date", *[f"c{i}" for i in range(32_762)]])
    put(folder, "widest.csv", f"{wide}\n1|2|Flu|2024-01-05\n")
    put(folder, "wider.csv", f"{wide}|c\n1|2|Flu|2024-01-05\n")
    put(folder, "row.csv", f"{HEADER}\n1|2|n|d|Flu|2024-01-05{'|' * 70_000}\n")
    records, rejects, _ = read(spark, folder, REGISTRY)
    assert rejects.pop("row.csv") == (2, "date")
    assert rejects == {"wider.csv": (1, "too_many_columns")} and len(records["widest.csv"]) == 1


# --- digests -----------------------------------------------------------------


def rolled(text):
    """The digest of decoded text, line by line from the front."""
    lines = text.decode("utf-8", "replace").splitlines(keepends=False) if text else []
    state = (0, 0, 0)
    for line in lines:
        head = hashlib.sha256(line.encode()).hexdigest()
        state = rolling.combine(state, (1, int(head[:7], 16) + 1, int(head[7:14], 16) + 1))
    return "%d-%08x%08x" % state


TEXTS = {
    "long.csv": "".join(f"{i},S,Flu,é,01/05/2024\n" for i in range(2000)).encode(),
    "swapped.csv": "".join(f"{i},S,Flu,é,01/05/2024\n" for i in [1, 0, *range(2, 2000)]).encode(),
    "windows.csv": b"a,b\r\nc\r\n",
    "same.csv": b"a,b\nc\n",
    "broken.csv": b"a\xff\xfeb\nJos\xe9,\xe2\x82\n\xf0\x9f\x98\n",
    "replaced.csv": b"a\xff\xfeb\nJos\xe9,\xe2\x82\n\xf0\x9f\x98\n".decode("utf-8", "replace").encode(),
}


@pytest.mark.parametrize("size", [1024, 10_000, 1 << 30])
def test_digests_know_order_and_no_splits(spark, folder, size):
    for name, text in TEXTS.items():
        put(folder, name, text)
    with splits_of(spark, size):
        found = files.file_digests(spark, folder).collect()
    got = {r["path"].rsplit("/", 1)[-1]: r for r in found}
    assert {name: r["ordered_digest"] for name, r in got.items()} == {n: rolled(t) for n, t in TEXTS.items()}
    digests = {name: r["ordered_digest"] for name, r in got.items()}
    assert digests["long.csv"] != digests["swapped.csv"]
    assert got["long.csv"]["line_digest"] == got["swapped.csv"]["line_digest"]
    assert digests["windows.csv"] == digests["same.csv"] and digests["broken.csv"] == digests["replaced.csv"]


def test_digests_of_parts_combine():
    rng = random.Random(1)
    lines = [(1, rng.randrange(1 << 28), rng.randrange(1 << 28)) for _ in range(30)]

    def whole(parts):
        state = (0, 0, 0)
        for part in parts:
            state = rolling.combine(state, part)
        return state

    for cut in range(31):
        assert rolling.combine(whole(lines[:cut]), whole(lines[cut:])) == whole(lines)


def test_a_landing_s_content_hash_is_the_ordered_digest(spark, folder):
    text = f"{HEADER}\n1|2|n|d|Flu|2024-01-05\n3|2|n|d|Flu|2024-01-05\n"
    put(folder, "a.csv", text)
    _, _, listed = read(spark, folder, REGISTRY)
    assert listed["a.csv"]["content_hash"] == rolled(text.encode())
