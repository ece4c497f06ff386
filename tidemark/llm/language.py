"""Language identification by the nearest of several centroids per language.

A text becomes a vector of letter n-grams (two and three bytes, hashed), its
counts damped by a logarithm, weighted by inverse document frequency and scaled
to length one.  Document frequencies are counted over all learning texts.  A
bounded sample per language is clustered by spherical k-means; a text takes the
language of the centroid with the largest cosine.  ``rejected`` marks texts
farther from their centroid than almost all of its own sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.session import stage

DIMENSIONS = 1 << 15
#: Rows the centroids are fitted on, all languages together.
SAMPLE_ROWS = 2000
CENTROIDS = 4
ROUNDS = 8
#: Of a centroid's sample, the share that would be rejected.
REJECTED_SHARE = 0.01
UNKNOWN = "und"

#: ASCII letters in lower case, other ASCII as space, bytes of other characters as they are.
_LETTERS = bytes(
    code + 32 if 65 <= code <= 90 else code if 97 <= code <= 122 or code >= 128 else 32
    for code in range(256)
)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the words of a text and their counts."""
    words = text.translate(_LETTERS).split()
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    twos = codes[:-1] << 8 | codes[1:]
    threes = (twos[:-1] << 8 | codes[2:]) + np.uint32(1 << 24)
    grams = np.concatenate([twos, threes])
    counts = np.bincount((grams * np.uint32(2654435761)) >> 17, minlength=DIMENSIONS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def vector(text: bytes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = features(text)
    weights = ((1 + np.log(counts)) * idf[at]).astype(np.float32)
    length = float(np.sqrt((weights * weights).sum()))
    return at, weights / length if length else weights


def has_letter(text: bytes | None) -> bool:
    return bool(text) and any(map(str.isalpha, text.decode("utf-8", "replace")))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            total[features(text.as_py() or b"")[0]] += 1
        n += batch.num_rows
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(at, -1).astype(np.int32)), pa.array(np.append(total[at], n))],
        names=["feature", "n"],
    )


def _vectors(idf: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vector(text.as_py() or b"", idf) for text in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("lang"),
                    pa.array([at.astype("<i4").tobytes() for at, _ in found], pa.binary()),
                    pa.array([w.astype("<f4").tobytes() for _, w in found], pa.binary()),
                ],
                names=["lang", "at", "weights"],
            )

    return run


def cluster(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit rows, and for each the cosine that few of its rows stay below."""
    chosen = [0]
    near = rows @ rows[0]
    while len(chosen) < min(k, len(rows)):  # the row farthest from those chosen
        chosen.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[chosen[-1]])
    centres = rows[chosen]
    for _ in range(ROUNDS):
        own = (rows @ centres.T).argmax(1)
        sums = np.stack([rows[own == i].sum(0) if (own == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cosines = rows @ centres.T
    own = cosines.argmax(1)
    limits = [
        np.quantile(cosines[own == i, i], REJECTED_SHARE) if (own == i).any() else 0.0
        for i in range(len(centres))
    ]
    return centres.astype(np.float32), np.asarray(limits)


def _predict(idf: np.ndarray, centres: np.ndarray, owners: list[str], limits: np.ndarray):
    by_feature = np.ascontiguousarray(centres.T)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text in batch.column("_text"):
                text = text.as_py()
                if not owners or not has_letter(text):
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                at, weights = vector(text, idf)
                cosines = weights @ by_feature[at]
                best = int(cosines.argmax())
                langs.append(owners[best])
                scores.append(min(max(float(cosines[best]), 0.0), 1.0))
                rejected.append(bool(cosines[best] < limits[best]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("held_out"),
                    pa.array(langs),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected),
                ],
                names=["_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return run


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    folds: int = 4,
    held_fold: int = 2,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``id_col, held_out, lang_pred, score, rejected`` for every whole text.

    A text is held out if crc32 of its id as text, modulo ``folds``, is
    ``held_fold`` (a null id: not held out).  Texts learnt from are those not
    held out, with a text and a language.  A null text and one without a letter
    is ``und`` with score 0; so is everything if there is nothing to learn from.
    Equal cosines go to the language first in order.  Repeated rows are learnt
    from and predicted each.  Other columns don't matter.  An empty table gives
    an empty result.
    """
    held = F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(folds)) == held_fold
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.col(f"`{text_col}`").cast("binary").alias("_text"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("_row"),
        F.col(f"`{lang_col}`").cast("string").alias("_lang"),
    ).withColumn("held_out", F.coalesce(held, F.lit(False)))
    known = rows.where("not held_out and _text is not null and _lang is not null")
    counts = stage(
        known.select("_text").mapInArrow(_frequencies, "feature int, n long")
        .groupBy("feature").agg(F.sum("n").alias("n")),
        "frequencies",
    )
    table = {row["feature"]: row["n"] for row in counts.collect()}  # one row per dimension
    n = table.pop(-1, 0) or 0
    frequency = np.zeros(DIMENSIONS)
    for feature, count in table.items():
        frequency[feature] = count
    idf = np.log((1 + n) / (1 + frequency)) + 1
    sizes = {row["_lang"]: row["n"] for row in known.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    centres, owners, limits = [], [], []
    if sizes:
        each = max(1, sample_rows // len(sizes))
        bound = F.lit(0.0)
        for lang, size in sizes.items():
            bound = F.when(F.col("_lang") == lang, min(1.0, each / size)).otherwise(bound)
        # A fixed share of each language, by a hash of the row.
        part = F.pmod(F.col("_row"), F.lit(1_000_003)) < bound * 1_000_003
        drawn = known.where(part).select(F.col("_lang").alias("lang"), "_text")
        drawn = drawn.mapInArrow(_vectors(idf), "lang string, at binary, weights binary")
        found = stage(drawn, "sample").toPandas()
        for lang in sorted(set(found["lang"])):
            own = found[found["lang"] == lang]
            dense = np.zeros((len(own), DIMENSIONS), np.float32)
            for i, (at, weights) in enumerate(zip(own["at"], own["weights"])):
                dense[i, np.frombuffer(at, "<i4")] = np.frombuffer(weights, "<f4")
            order = np.lexsort((dense @ np.arange(DIMENSIONS, dtype=np.float32),))
            made, least = cluster(dense[order], CENTROIDS)
            centres.append(made)
            limits.append(least)
            owners += [lang] * len(made)
    stacked = np.concatenate(centres) if centres else np.zeros((0, DIMENSIONS), np.float32)
    return rows.select("_id", "held_out", "_text").mapInArrow(
        _predict(idf, stacked, owners, np.concatenate(limits) if limits else np.zeros(0)),
        "_id long, held_out boolean, lang_pred string, score double, rejected boolean",
    ).withColumnRenamed("_id", id_col)
