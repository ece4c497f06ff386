from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.queries import op11_embedding_whitening, table

SF_DIR = "/root/testdata/sf0.01"


def brute(vectors, weights=None, components=32):
    """x, n, deviation per vector, and eigenvalues and vectors, by exact sums."""
    x = [[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in vectors]
    if weights == "one":
        fit = [list(t) for t in set(map(tuple, x))]
    else:
        fit = x
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    off = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    mine = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(v, sums)] for v in x])
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, len(values))
    with np.errstate(divide="ignore", invalid="ignore"):
        return n, off, mine @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def compare(rows, ids, expected):
    n, off, whitened, explained = expected
    k = whitened.shape[1]
    assert Counter((r.vec_id, r.component) for r in rows) == Counter((i, c + 1) for i in ids for c in range(k))
    got = np.zeros_like(whitened)
    place = {i: at for at, i in enumerate(ids)}
    for r in rows:
        assert (r.n, r.deviation) == (n, off[place[r.vec_id]])
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        got[place[r.vec_id], r.component - 1] = r.whitened
    signs = np.sign((got * whitened).sum(0))
    assert np.abs(got * signs - whitened).max() < 1e-8
    (error,) = {r.identity_error for r in rows}
    assert error < 1e-9
    return got


def test_the_query_equals_brute_force(spark):
    rows = table(spark, SF_DIR, "embeddings").collect()
    got = op11_embedding_whitening(spark, SF_DIR).collect()
    compare(got, [r.vec_id for r in rows], brute([r.embedding for r in rows]))


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return made.selectExpr("*", *[f"'x' as `{c}`" for c in ("id", "code", "copies", "n", "component", "length")])


@pytest.fixture(scope="module")
def vectors():
    """A third of all rows are one vector; the others repeat by two and three."""
    rng = np.random.default_rng(3)
    own = rng.normal(size=(60, 6)) @ rng.normal(size=(6, 6))
    own = own.tolist()
    return [*own, *own[:30], *own[:10], *[own[0]] * 55]


@pytest.mark.parametrize("weights", ["copies", "one"])
def test_copies_count_or_not(spark, vectors, weights):
    got = whitening.whiten(frame(spark, list(enumerate(vectors))), weights=weights).collect()
    compare(got, range(len(vectors)), brute(vectors, weights))
    assert len({r.whitened for r in got if r.component == 1}) == 60


@pytest.mark.parametrize("hot", [1, 3, 40])
def test_hot_vectors_are_joined_alike(spark, vectors, monkeypatch, hot):
    monkeypatch.setattr(whitening, "HOT", hot)
    got = whitening.whiten(frame(spark, list(enumerate(vectors))), components=4).collect()
    compare(got, range(len(vectors)), brute(vectors, components=4))


def test_entries_of_any_size_are_exact(spark):
    rows = [[1.0, 300.0, 2.0**40], [-5.0, 1e9, -(2.0**40)], [2.5, -300.25, 7.0], [1.0, 300.0, 2.0**40], [3.0, 1.0, 0.0]]
    got = whitening.whiten(frame(spark, list(enumerate(rows)))).collect()
    n, off, _, _ = brute(rows)
    assert {r.vec_id: r.deviation for r in got} == {
        i: value if value < 1 << 63 else None for i, value in enumerate(off)
    }
    model = whitening.Model(3, (10, -2), np.zeros(2), np.zeros(2), np.eye(2), np.ones(2), (0.5, 0.5))
    for scale in (1, 10**8, 10**9, 2 * 10**9):
        entries = np.array([[5, -7], [0, 1]]) * scale
        want = [sum((3 * int(v) - s) ** 2 for v, s in zip(row, (10, -2))) for row in entries]
        assert whitening.deviations(model, entries) == [w if w < 1 << 63 else None for w in want]


def test_packing_is_exact():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    for bits in (5, 7, 8, 15, 16, 31, 32, 60):
        entries = rng.integers(-(1 << bits), 1 << bits, (50, 7))
        codes = pa.array(whitening.pack(entries), pa.binary())
        back = np.zeros_like(entries)
        for at, found in whitening.unpack(codes):
            back[at] = found
        assert (back == entries).all()
        assert len(set(whitening.pack(np.repeat(entries, 2, 0)))) == len({tuple(e) for e in entries.tolist()})


def test_odd_rows(spark, vectors):
    nan, inf = float("nan"), float("inf")
    odd = [(1000, None), (1001, [1.0, None]), (1002, [nan, 1.0]), (1003, [inf, 1.0]), (1004, [-inf]), (1005, []),
           (1006, [1e300, 0.0]), (None, None)]
    twos = [(2000 + i, [float(i), float(i * i)]) for i in range(5)] + [(None, [1.0, 1.0]), (2000, [0.0, 0.0])]
    rows = whitening.whiten(frame(spark, [*enumerate(vectors), *odd, *twos])).collect()
    six = [r for r in rows if r.n == len(vectors)]
    compare(six, range(len(vectors)), brute(vectors))
    two = [r for r in rows if r.n == len(twos)]
    assert Counter(r.vec_id for r in two) == {**{2000 + i: 2 for i in range(1, 5)}, 2000: 4, None: 2}
    assert len(rows) == len(six) + len(two)


def test_without_variance(spark):
    rows = whitening.whiten(frame(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).collect()
    assert {(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {
        (i, c, 2, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    }
    one = whitening.whiten(frame(spark, [(i, [float(i), 1.0]) for i in range(4)])).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in one)
    assert {round(r.explained, 12) for r in one} == {1.0, 0.0} and one[0].identity_error < 1e-12
    assert whitening.whiten(frame(spark, [])).collect() == []
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, []), weights="two")
