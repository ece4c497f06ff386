"""Quality classifier by compression with dictionaries of good and bad text.

Two zstandard dictionaries are trained, one on pieces of texts labelled good and
one on pieces of texts labelled bad.  A text is compressed whole with each,
piece by piece so that the dictionary counts as much at its end as at its start;
the difference of the two sizes, divided by the text's size, says which kind of
text it is like.  A logistic curve through labelled texts that no dictionary has
seen turns the difference into a probability.

What is learnt from is bounded: about ``sample_rows`` label rows, whatever the
corpus, half for the dictionaries and half for the curve.  Labels that are taken
are few enough to be broadcast, so texts are never shuffled; scoring reads every
whole text once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import stage

#: Bytes of text compressed at a time.
PIECE = 2048
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
#: Label rows learnt from, about; half of them make the dictionaries.
SAMPLE_ROWS = 20_000
#: Pieces of each kind of text that a dictionary is trained on, at most.
SAMPLE_PIECES = 2_500
#: Differences are counted in steps of this size for the curve.
STEP = 1 / 512
_SLICES = 1_000_003


def pieces(text: bytes) -> list[bytes]:
    return [text[at : at + PIECE] for at in range(0, len(text), PIECE)]


def train(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; the samples themselves where they are too few to train on."""
    import zstandard

    size = min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 2))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Sizes:
    """Compressed sizes of texts with one dictionary."""

    def __init__(self, dictionary: bytes) -> None:
        import zstandard

        self._compress = zstandard.ZstdCompressor(
            level=LEVEL,
            dict_data=zstandard.ZstdCompressionDict(dictionary),
            write_content_size=False,
            write_dict_id=False,
        ).compress

    def of(self, text: bytes) -> int:
        return sum(len(self._compress(piece)) for piece in pieces(text))


def differences(good: bytes, bad: bytes, texts: pa.Array) -> np.ndarray:
    """For each text, by how much of its size the good dictionary does better."""
    by_good, by_bad = Sizes(good), Sizes(bad)
    found = np.zeros(len(texts))
    for i, value in enumerate(texts):
        text = value.as_py()
        if text:
            found[i] = (by_bad.of(text) - by_good.of(text)) / len(text)
    return found


def fit(steps: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of the likeliest logistic curve through counted steps.

    Newton's method on the two parameters, with a slight pull towards a flat
    curve at the share of good texts, so that separable counts have an end.
    """
    n, ones = float(good.sum() + bad.sum()), float(good.sum())
    prior = math.log((ones + 1) / (n - ones + 1))
    scale = max(float(np.abs(steps).max(initial=0.0)), 1e-9)
    x = np.stack([steps / scale, np.ones(len(steps))])
    at = np.array([0.0, prior])
    pull = np.array([1e-3, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(at @ x, -500, 500)))
        slope = x @ (good - (good + bad) * p) - pull * (at - [0.0, prior])
        bend = (x * ((good + bad) * p * (1 - p))) @ x.T + np.diag(pull)
        move = np.linalg.solve(bend, slope)
        move *= min(1.0, 10 / max(np.abs(move).max(), 1e-12))
        at = at + move
        if np.abs(move).max() < 1e-9:
            break
    return at[0] / scale, at[1]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts as labelled pieces."""
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), batch.column("text")):
            cut = pieces(text.as_py() or b"")
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(cut), pa.int32()), pa.array(cut, pa.binary())],
                names=["label", "piece"],
            )


def _stepped(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps = np.rint(differences(good, bad, batch.column("text")) / STEP)
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(steps.astype(np.int64))], names=["label", "step"]
            )

    return run


def _scored(good: bytes, bad: bytes, slope: float, intercept: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = differences(good, bad, batch.column("text"))
            score = 1 / (1 + np.exp(-np.clip(slope * found + intercept, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("held_out"),
                    pa.array(score),
                    pa.array((score >= 0.5).astype(np.int32)),
                    pa.array(found),
                ],
                names=["id", "held_out", "score", "predicted", "difference"],
            )

    return run


def _held(doc_id: Column, folds: int, fold: int) -> Column:
    of_id = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold
    return F.coalesce(of_id, F.lit(False))


def _labelled(labels: DataFrame, id_col: str, label_col: str, folds: int, fold: int, most: int) -> DataFrame:
    """``id, label, part``: about ``most`` of the usable labels, those with the least hashes.

    A document with both labels says nothing and is left out.
    """
    usable = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    usable = usable.where("id is not null and label in (0, 1)").where(~_held(F.col("id"), folds, fold))
    agreed = usable.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    agreed = stage(agreed.where("label = other").select("id", "label"), "labels")
    share = most / max(agreed.count(), 1)
    slot = F.pmod(F.xxhash64("id"), F.lit(_SLICES))
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(2)).alias("part")
    return agreed.where(slot < share * _SLICES).select("id", "label", part)


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    folds: int = 3,
    held_fold: int = 1,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``id_col, held_out, score, predicted, difference`` for every row of ``docs``.

    A document is held out if crc32 of its id as text, modulo ``folds``, is
    ``held_fold`` (a null id: not held out, and never labelled).  Learnt from are
    ``sample_rows`` label rows, about, of documents not held out; labels other
    than 0 and 1, null ids and documents with both labels are passed over.  If a
    dictionary can't be made, because no text of a label was found, every score
    is the share of good labels, 0.5 without any.  Null and empty texts have the
    difference 0 and the score that goes with it.  Repeated rows are scored each;
    a label counts for every row of its id.  Other columns don't matter.  An
    empty table gives an empty result.
    """
    taken = _labelled(labels, id_col, label_col, folds, held_fold, sample_rows)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )
    # At most about ``sample_rows`` rows of two numbers.
    learnt = rows.join(F.broadcast(taken), "id")
    cut = stage(
        learnt.where("part = 0").select("label", "text").mapInArrow(_cut, "label int, piece binary"),
        "pieces",
    )
    samples = []
    for label in (0, 1):
        own = cut.where(F.col("label") == label).select("piece", F.xxhash64("piece").alias("h"))
        drawn = own.orderBy("h", "piece").limit(SAMPLE_PIECES).collect()
        samples.append([bytes(row["piece"]) for row in drawn])
    counts = {0: len(samples[0]), 1: len(samples[1])}
    slope, intercept, good, bad = 0.0, 0.0, b"", b""
    if all(counts.values()):
        bad, good = train(samples[0]), train(samples[1])
        counted = (
            learnt.where("part = 1").select("label", "text")
            .mapInArrow(_stepped(good, bad), "label int, step long")
            .groupBy("step").agg(F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
            .orderBy("step").collect()  # differences lie between -1 and 1
        )
        if counted:
            steps, ones, zeros = np.array(counted, float).T
            slope, intercept = fit(steps * STEP, ones, zeros)
    elif any(counts.values()):
        ones = taken.agg(F.sum("label").alias("good"), F.count(F.lit(1)).alias("all")).first()
        intercept = math.log((ones["good"] + 1) / (ones["all"] - ones["good"] + 1))
    marked = rows.select("id", _held(F.col("id"), folds, held_fold).alias("held_out"), "text")
    kind = docs.schema[id_col].dataType.simpleString()
    return marked.mapInArrow(
        _scored(good, bad, slope, intercept),
        f"id {kind}, held_out boolean, score double, predicted int, difference double",
    ).withColumnRenamed("id", id_col)

