import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import numbering


def test_chunks_are_full_but_the_last_and_keep_the_order(spark):
    rows = [(i,) for i in range(25)]
    random.Random(1).shuffle(rows)
    numbered = numbering.chunks(spark.createDataFrame(rows, "n long").repartition(4), ["n"], 10)
    got = sorted((r["n"], r["chunk_no"]) for r in numbered.rows.collect())
    assert got == [(i, i // 10 + 1) for i in range(25)]
    assert numbered.total == 25


def test_no_rows_give_no_chunks(spark):
    numbered = numbering.chunks(spark.range(0), ["id"], 10)
    assert numbered.total == 0
    assert numbered.rows.count() == 0


def test_a_chunk_holds_at_least_one_record(spark):
    with pytest.raises(ValueError):
        numbering.chunks(spark.range(3), ["id"], 0)


@pytest.mark.parametrize("hot_rows", [5_000_000, 40, 1])
def test_sequences_are_the_same_however_groups_are_spread(spark, hot_rows):
    rng = random.Random(7)
    # One group holds a third of all rows.
    rows = [("hot" if rng.random() < 0.34 else f"g{rng.randrange(20)}", rng.randrange(50), i)
            for i in range(900)]
    df = spark.createDataFrame(rows, "g string, at long, i long").repartition(6)
    got = numbering.sequence(df, ["g"], ["at", "i"], hot_rows=hot_rows)
    expected = {}
    for group in {r[0] for r in rows}:
        for seq, row in enumerate(sorted(r[1:] for r in rows if r[0] == group), start=1):
            expected[row[1]] = seq
    assert {r["i"]: r["seq"] for r in got.collect()} == expected
    assert got.columns == ["g", "at", "i", "seq"]


@pytest.mark.parametrize("hot_rows", [5_000_000, 10])
def test_segments_are_bounded_and_whole(spark, hot_rows):
    df = spark.range(257).select(F.lit("g").alias("g"), F.col("id").alias("n"))
    got = numbering.segments(df, ["g"], ["n"], F.col("n"), 100, hot_rows=hot_rows)
    parts = {r["segment"]: r["items"] for r in got.collect()}
    assert parts == {1: list(range(100)), 2: list(range(100, 200)), 3: list(range(200, 257))}
