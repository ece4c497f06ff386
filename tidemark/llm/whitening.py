"""Whitening of embeddings through the covariance of distinct integer vectors.

Entries become integers ``x = floor(64 * c) + 1000000``.  Equal vectors are
grouped first and carry their number of copies as fit weight (or one each, as
asked), so every further step works on distinct vectors:

1. Vectors are packed into as few bytes as their entries need and counted.
2. Weighted sums give the mean, exactly: they are added as decimals.
3. Centred vectors, scaled by their weights, are multiplied with themselves one
   batch at a time; tasks send one matrix each, added up row by row.
4. The driver takes eigenvectors of a matrix of the size dimensions squared.
5. Each distinct vector is whitened and joined back to the rows that hold it.

A vector that holds more than one in :data:`HOT` of all rows is joined by
broadcast, and of those there are fewer than :data:`HOT`; every other key of the
join has few rows.  Vectors of different lengths are fitted apart, by length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.session import small_frame, stage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: An entry this large has no long form; its row goes as one that isn't finite.
TOO_LARGE = float(1 << 56)
#: A vector with more than this part of all rows is joined by broadcast.
HOT = 1024
#: An eigenvalue below this part of the largest, times the dimensions, is rounding.
_ROUNDING = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Model:
    """What is fitted to the vectors of one length; entries without the shift."""

    n: int
    sums: tuple[int, ...]
    #: Mean of the entries, and of the centred entries (nothing but rounding).
    mean: np.ndarray
    residue: np.ndarray
    #: One column per component, by falling eigenvalue, and its scale (0: no variance).
    axes: np.ndarray
    scales: np.ndarray
    explained: tuple[float | None, ...]

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        return (centred @ self.axes) * self.scales


def pack(entries: np.ndarray) -> list[bytes]:
    """Rows of entries as bytes: a width, then the entries in that many bytes each.

    Equal rows give equal bytes and no others do.
    """
    low, high = entries.min(1, initial=0), entries.max(1, initial=0)
    widths = np.full(len(entries), 8)
    for width in (4, 2, 1):
        half = 1 << (8 * width - 1)
        widths[(low >= -half) & (high < half)] = width
    packed: list[bytes] = [b""] * len(entries)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        first = bytes([width])
        for i, row in zip(at, entries[at].astype(f"<i{width}")):
            packed[i] = first + row.tobytes()
    return packed


def unpack(codes: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and entries of packed vectors, for each length and width."""
    values = [code.as_py() for code in codes]
    kinds: dict[tuple[int, int], list[int]] = {}
    for i, value in enumerate(values):
        kinds.setdefault((value[0], len(value)), []).append(i)
    for (width, size), at in sorted(kinds.items()):
        joined = b"".join(values[i][1:] for i in at)
        entries = np.frombuffer(joined, f"<i{width}").reshape(len(at), (size - 1) // width)
        yield np.asarray(at), entries.astype(np.int64)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        offsets = np.asarray(vectors.offsets)
        values = np.floor(SCALE * np.asarray(vectors.values)).astype(np.int64)
        lengths = np.diff(offsets)
        codes: list[bytes] = [b""] * len(lengths)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            entries = values[offsets[at][:, None] + np.arange(length)]
            for i, code in zip(at, pack(entries)):
                codes[i] = code
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(codes, pa.binary())], names=["id", "code"]
        )


def _weights(batch: pa.RecordBatch, by_copies: bool) -> np.ndarray:
    copies = np.asarray(batch.column("copies"))
    return copies if by_copies else np.ones_like(copies)


def _exact_sum(weights: np.ndarray, entries: np.ndarray) -> list[int]:
    largest = int(np.abs(entries).max(initial=0))
    if largest * int(weights.sum()) < 1 << 62:
        return (weights @ entries).tolist()
    return (weights.astype(object) @ entries.astype(object)).tolist()


def _sums(by_copies: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            weights = _weights(batch, by_copies)
            for at, entries in unpack(batch.column("code")):
                total = totals.setdefault(entries.shape[1], [0] * (entries.shape[1] + 1))
                found = [int(weights[at].sum()), *_exact_sum(weights[at], entries)]
                totals[entries.shape[1]] = [a + b for a, b in zip(total, found)]
        for length, total in sorted(totals.items()):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * (length + 1), pa.int32()),
                    pa.array(range(length + 1), pa.int32()),
                    pa.array(total, pa.decimal128(38, 0)),
                ],
                names=["length", "i", "total"],
            )

    return run


def _products(
    by_copies: bool, means: dict[int, np.ndarray], change: Callable[[int, np.ndarray], np.ndarray]
):
    """Weighted products of centred and changed vectors, one matrix row at a time.

    The last row of each length holds the weighted sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            weights = _weights(batch, by_copies).astype(np.float64)
            for at, entries in unpack(batch.column("code")):
                length = entries.shape[1]
                if length not in means:
                    continue
                vectors = change(length, entries - means[length])
                weighted = vectors * weights[at][:, None]
                found = np.concatenate([weighted.T @ vectors, weighted.sum(0)[None]])
                totals[length] = totals.get(length, 0.0) + found
        for length, total in sorted(totals.items()):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * len(total), pa.int32()),
                    pa.array(range(len(total)), pa.int32()),
                    pa.array([row.astype("<f8").tobytes() for row in total], pa.binary()),
                ],
                names=["length", "i", "cells"],
            )

    return run


def _added(table: pa.Table) -> pa.Table:
    rows = np.stack([np.frombuffer(cells.as_py(), "<f8") for cells in table.column("cells")])
    return pa.table(
        {
            "length": table.column("length").slice(0, 1),
            "i": table.column("i").slice(0, 1),
            "cells": pa.array([np.sort(rows, 0).sum(0).tobytes()], pa.binary()),
        }
    )


def _moments(distinct: DataFrame, by_copies: bool, means, change) -> dict[int, np.ndarray]:
    """For each length the added products and, last, the sums: (k + 1) rows of k numbers."""
    kind = "length int, i int, cells binary"
    parts = distinct.mapInArrow(_products(by_copies, means, change), kind)
    rows = parts.groupBy("length", "i").applyInArrow(_added, kind).collect()
    found: dict[int, list] = {}
    for row in sorted(rows, key=lambda row: (row["length"], row["i"])):
        found.setdefault(row["length"], []).append(np.frombuffer(row["cells"], "<f8"))
    return {length: np.stack(held) for length, held in found.items()}


def _unchanged(length: int, centred: np.ndarray) -> np.ndarray:
    return centred


def fit(distinct: DataFrame, by_copies: bool = True, components: int = COMPONENTS) -> dict[int, Model]:
    """A model per length of the packed vectors in ``code`` with their ``copies``."""
    totals = (
        distinct.mapInArrow(_sums(by_copies), "length int, i int, total decimal(38,0)")
        .groupBy("length", "i").agg(F.sum("total").alias("total"))
        .orderBy("length", "i").collect()
    )
    exact: dict[int, list[int]] = {}
    for row in totals:
        exact.setdefault(row["length"], []).append(int(row["total"]))
    exact = {length: held for length, held in exact.items() if length}
    means = {
        length: np.array([float(Fraction(total, held[0])) for total in held[1:]])
        for length, held in exact.items()
    }
    models = {}
    for length, moments in _moments(distinct, by_copies, means, _unchanged).items():
        n, sums = exact[length][0], exact[length][1:]
        values, axes = np.linalg.eigh(moments[:-1] / n)
        values, axes = np.maximum(values[::-1], 0.0), axes[:, ::-1]
        trace = float(values.sum())
        values, axes = values[:components], axes[:, :components]
        axes = axes * np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
        varies = values > _ROUNDING * length * values[:1]
        scales = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1.0)), 0.0)
        explained = tuple(float(value) / trace if trace else None for value in values)
        models[length] = Model(n, tuple(sums), means[length], moments[-1] / n, axes, scales, explained)
    return models


def identity_errors(distinct: DataFrame, models: dict[int, Model], by_copies: bool) -> dict[int, float | None]:
    """For each length how far the whitened vectors' covariance is from the identity.

    Components without variance are left out; none left gives null.
    """

    def change(length: int, centred: np.ndarray) -> np.ndarray:
        return models[length].whiten(centred - models[length].residue)

    found: dict[int, float | None] = {}
    means = {length: model.mean for length, model in models.items()}
    for length, moments in _moments(distinct, by_copies, means, change).items():
        varies = models[length].scales > 0
        off = np.abs(moments[:-1] / models[length].n - np.eye(len(varies)))[varies][:, varies]
        found[length] = float(off.max()) if varies.any() else None
    return found


def deviations(model: Model, entries: np.ndarray) -> list[int | None]:
    """Sums over dimensions of (n * x - S) squared; none where a long can't hold it."""
    most = model.n * int(np.abs(entries).max(initial=0)) + max(map(abs, model.sums), default=0)
    if most * most * entries.shape[1] < 1 << 63:
        off = model.n * entries - np.array(model.sums, np.int64)
        return (off * off).sum(1).tolist()
    off = entries.astype(object) * model.n - np.array(model.sums, object)
    return [total if total < 1 << 63 else None for total in (off * off).sum(1).tolist()]


def _whitened(models: dict[int, Model]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            lengths, off = np.zeros(n, np.int32), [None] * n
            found: list[np.ndarray | None] = [None] * n
            for at, entries in unpack(batch.column("code")):
                model = models.get(entries.shape[1])
                if model is None:
                    continue
                lengths[at] = entries.shape[1]
                values = model.whiten(entries - model.mean)
                for i, vector, deviation in zip(at, values, deviations(model, entries)):
                    found[i], off[i] = vector, deviation
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("code"),
                    batch.column("copies"),
                    pa.array(lengths),
                    pa.array(off, pa.int64()),
                    pa.array(found, pa.list_(pa.float64())),
                ],
                names=["code", "copies", "length", "deviation", "values"],
            )

    return run


def _facts(spark, models: dict[int, Model], errors: dict[int, float | None]) -> DataFrame:
    """What is the same for all vectors of a length: a row per length and component."""
    rows = [
        {
            "length": length,
            "component": i + 1,
            "n": model.n,
            "explained": model.explained[i],
            "varies": bool(model.scales[i] > 0),
            "identity_error": errors.get(length),
        }
        for length, model in sorted(models.items())
        for i in range(len(model.scales))
    ]
    columns = pa.schema(
        [
            ("length", pa.int32()),
            ("component", pa.int32()),
            ("n", pa.int64()),
            ("explained", pa.float64()),
            ("varies", pa.bool_()),
            ("identity_error", pa.float64()),
        ]
    )
    schema = spark.createDataFrame([], "length int, component int, n long, explained double, varies boolean, identity_error double").schema
    return small_frame(spark, rows, columns, schema)


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    weights: str = "copies",
    components: int = COMPONENTS,
) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``.

    A row for each remaining row and component up to ``components``.  Rows whose
    vector is null, or holds an entry that is null, not finite or too large for a
    long, are dropped.  ``weights`` says what a distinct vector counts in the fit:
    its ``copies``, or ``one``; ``n`` and the sums are those of the fit.  Vectors
    of different lengths are tables of their own; an empty vector has no
    component.  A component without variance (fewer distinct vectors than
    dimensions, constant entries) has null in ``whitened``, and all of them null
    in ``explained`` if nothing varies.  ``deviation`` is null where a long can't
    hold it.  Null and repeated ids are kept, repeated rows get equal results,
    other columns don't matter, and an empty table gives an empty result.
    Components of equal eigenvalues are any basis of theirs.
    """
    if weights not in ("copies", "one"):
        raise ValueError(f"weights are 'copies' or 'one', not {weights!r}")
    by_copies = weights == "copies"
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    # Not a number counts as larger than any.
    fits = F.forall("vector", lambda entry: entry.isNotNull() & (F.abs(entry) < TOO_LARGE))
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = stage(rows.where(fits).mapInArrow(_packed, f"id {kind}, code binary"), "packed")
    distinct = stage(rows.groupBy("code").agg(F.count(F.lit(1)).alias("copies")), "distinct")
    models = fit(distinct, by_copies, components)
    errors = identity_errors(distinct, models, by_copies)
    total = rows.count()

    def whitened(part: DataFrame) -> DataFrame:
        kind = "code binary, copies long, length int, deviation long, values array<double>"
        return part.mapInArrow(_whitened(models), kind).drop("copies")

    hot = distinct.where(F.col("copies") * HOT > total)
    if hot.isEmpty():
        joined = rows.join(whitened(distinct), "code")
    else:
        hot = stage(hot, "hot")  # fewer than HOT rows
        cold = distinct.where(F.col("copies") * HOT <= total)
        rest = rows.join(F.broadcast(hot.select("code")), "code", "left_anti")
        joined = rest.join(whitened(cold), "code").unionByName(
            rows.join(F.broadcast(whitened(hot)), "code")
        )
    each = joined.select("id", "length", "deviation", F.posexplode("values").alias("pos", "whitened"))
    each = each.withColumn("component", F.col("pos") + 1)
    told = each.join(F.broadcast(_facts(spark, models, errors)), ["length", "component"])
    return told.select(
        F.col("id").alias(id_col),
        "component",
        "n",
        "deviation",
        F.when(F.col("varies"), F.col("whitened")).alias("whitened"),
        "explained",
        "identity_error",
    )
