import datetime as dt
import random

import pytest

from tidemark.operators import records
from tidemark.schema import KEY

DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(4)]


def draw(rng, n):
    """Rows from a small space, so copies and overlaps are common."""
    return [
        (str(rng.randrange(12)), rng.choice("ab"), rng.choice(["Flu", "MMR"]), str(rng.choice(DAYS)))
        for _ in range(n)
    ]


def as_set(df):
    rows = [(r[0], r[1], r[2], str(r[3])) for r in df.select(*KEY).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", range(4))
def test_algebra_agrees_with_sets(spark, frame, seed):
    rng = random.Random(seed)
    a, b = draw(rng, 60), draw(rng, 40)
    left, right = frame(a), frame(b)
    one, two = records.dedupe(left), records.dedupe(right)
    assert as_set(one) == set(a)
    assert as_set(records.union(left, right)) == set(a) | set(b)
    assert as_set(records.union_all([left, right, left])) == set(a) | set(b)
    new = records.diff(one, two)
    assert as_set(new) == set(a) - set(b)
    assert as_set(records.hits(one, two)) == set(a) & set(b)
    master = records.advance(two, new)
    assert as_set(master) == set(a) | set(b)
    assert master.count() == two.count() + new.count()
    assert records.diff(one, master).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_every_shape_of_the_diff_is_the_same(spark, frame, seed):
    rng = random.Random(100 + seed)
    a, b = draw(rng, 80), draw(rng, 40)
    current, known = records.dedupe(frame(a)), records.dedupe(frame(b))
    wanted = set(a) - set(b)
    assert as_set(records.diff_broadcast(current, known)) == wanted
    assert as_set(records.diff_hashed(current, known)) == wanted
    # A known set with copies in it makes no difference.
    assert as_set(records.diff_broadcast(current, frame(b + b))) == wanted
    for size in [records.Size(1, 1), records.Size(1, 10**8), records.Size(1, 10**15)]:
        assert as_set(records.new_records(current, known, size, 8)) == wanted


def test_diff_filters_and_does_not_dedupe(frame):
    twice = frame([("1", "a", "Flu", "2024-01-01")] * 2 + [("2", "a", "Flu", "2024-01-01")])
    known = frame([("2", "a", "Flu", "2024-01-01")])
    assert records.diff(twice, known).count() == 2


def test_first_seen_keeps_the_first_position(frame):
    rows = [("1", "a", "Flu", "2024-01-01", 5), ("1", "a", "Flu", "2024-01-01", 3),
            ("2", "a", "Flu", "2024-01-01", 4)]
    got = records.first_seen(frame(rows, ", n long"), "n")
    assert {r["id_1"]: r["first_seen"] for r in got.collect()} == {"1": 3, "2": 4}


def test_a_source_missing_for_one_run_is_not_new_when_it_returns(frame):
    both = frame([("1", "a", "Flu", "2024-01-01"), ("2", "b", "Flu", "2024-01-01")])
    only_a = frame([("1", "a", "Flu", "2024-01-01")])
    master = records.advance(both, records.diff(only_a, both))
    assert records.diff(both, master).count() == 0


def test_counts_per_group(frame):
    known = frame([("1", "a", "Flu", "2024-01-01"), ("2", "b", "Flu", "2024-01-01")])
    current = frame([("1", "a", "Flu", "2024-01-01"), ("3", "a", "Flu", "2024-01-01")])
    new = records.diff(current, known)
    got = {r["id_2"]: tuple(r)[1:] for r in records.counts(current, known, new, ["id_2"]).collect()}
    assert got == {"a": (1, 2, 1, 2), "b": (0, 0, 1, 1)}


def test_measure_counts_rows_and_bytes(frame):
    size = records.measure(frame([("12345", "S1", "Flu", "2024-01-01")] * 3))
    assert size.rows == 3
    assert size.bytes == 3 * (10 + records.ROW_OVERHEAD)


def test_only_a_batch_of_checked_size_is_broadcast(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = frame([("1", "a", "Flu", "2024-01-01")])
        plans = [
            records.new_records(known, known, size, 8)._jdf.queryExecution().toString()
            for size in [records.Size(1, 100), records.Size(10**9, 10**15)]
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0]
    assert "BroadcastHashJoin" not in plans[1]
