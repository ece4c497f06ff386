"""Licence scans by a trained paragraph classifier.

A paragraph is a line of a text.  Its words (lower-cased letters and digits) and
word pairs are hashed features, counted sparsely and scaled to length one.  A
multinomial logistic regression over the licence families and an unknown class
is fitted to variations of fixed notices and to a bounded sample of lines from
the corpus that name no licence; a temperature, fitted on variations left out,
calibrates its probabilities.  A paragraph of a family must also hold most of
the word pairs of one of that family's notices; only then is it confirmed.

A long notice may be wrapped over lines or stand within a long one.  Lines without
a blank one between them are therefore cut into overlapping windows of words as
well; windows with a word that all long notices share some of (:data:`ANCHORS`)
are classified like lines and count if they are confirmed by a long notice.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import keyed
from tidemark.session import stage

DIMENSIONS = 1 << 12
#: Lines of the corpus the unknown class is learnt from.
SAMPLE_LINES = 1500
#: Variations made of each notice.
VARIATIONS = 40
STEPS = 300
UNKNOWN = "unknown"
LEAST_PROBABILITY = 0.5
#: Share of a notice's word pairs that a confirmed paragraph holds.
LEAST_OVERLAP = 0.6

#: Notices of so many word pairs are looked for across lines, in windows of so many words and steps.
LONG_PAIRS = 10
WINDOWS = ((20, 6), (40, 12))
#: Each long notice has one of these words.
ANCHORS = frozenset(b"license licence licensed permission redistribution copyright reserved".split())

#: Short notices by licence family, as they are commonly worded.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Released under CC0 1.0 Universal public domain dedication.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. Unauthorized copying of this file is strictly prohibited.",
    ],
}
#: Lines that name a licence are no examples of the unknown class.
_NAMED = r"(?i)licen[sc]e|copyright|rights reserved|public domain|spdx|permission is"

#: ASCII letters in lower case, digits and bytes of other characters as they are, the rest spaces.
_WORDS = bytes(
    code + 32 if 65 <= code <= 90
    else code if 97 <= code <= 122 or 48 <= code <= 57 or code >= 128
    else 32
    for code in range(256)
)
_ALTERNATE = 2654435761


def line_words(line: bytes) -> list[bytes]:
    return line.translate(_WORDS).split()


def word_codes(words: list[bytes]) -> np.ndarray:
    import zlib

    return np.fromiter(map(zlib.crc32, words), np.uint32, len(words))


def feature_rows(lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Features of many lines in a row, and how many each has; a line without words has none."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    codes = word_codes([word for line in lines for word in line])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(lines)), sizes)
    ones = (codes * np.uint32(_ALTERNATE)) >> np.uint32(20)
    pairs = np.empty(0, np.uint32)
    pair_owner = np.empty(0, np.int64)
    if len(codes) > 1:
        inside = np.ones(len(codes) - 1, bool)
        cut = ends[(ends > 0) & (ends < len(codes))] - 1
        inside[cut] = False
        mixed = codes[:-1] * np.uint32(31) + codes[1:] + np.uint32(7)
        pairs = ((mixed * np.uint32(_ALTERNATE)) >> np.uint32(20))[inside]
        pair_owner = owner[:-1][inside]
    rows = np.concatenate([owner, pair_owner])
    order = np.argsort(rows, kind="stable")
    both = np.concatenate([ones, pairs])[order].astype(np.int64)
    return both, np.bincount(rows, minlength=len(lines))


def logits(lines: list[list[bytes]], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    at, sizes = feature_rows(lines)
    out = np.zeros((len(lines), len(bias)))
    some = np.flatnonzero(sizes)
    if len(some):
        edges = np.r_[0, np.cumsum(sizes[some])[:-1]]
        out[some] = np.add.reduceat(weights[at], edges, axis=0) / np.sqrt(sizes[some])[:, None]
    return out + bias


def variations(notice: str, rng: np.random.Generator, filler: list[bytes]) -> Iterator[list[bytes]]:
    """The notice's words with some changed, dropped, or others set around it."""
    words = line_words(notice.encode())
    yield words
    for _ in range(VARIATIONS):
        kept = [w for w in words if len(words) < 4 or rng.random() > 0.08]
        kept = [
            b"%d" % rng.integers(0, 10) if w.isdigit() and rng.random() < 0.7 else w for w in kept
        ]
        if filler and rng.random() < 0.5:
            around = [filler[i] for i in rng.integers(0, len(filler), rng.integers(1, 12))]
            at = int(rng.integers(0, len(around) + 1))
            kept = around[:at] + kept + around[at:]
        yield kept


class Classifier:
    """Weights of the families, calibrated; :data:`UNKNOWN` is the last class."""

    def __init__(self, sample: list[list[bytes]]) -> None:
        rng = np.random.default_rng(0)
        self.classes = [*NOTICES, UNKNOWN]
        filler = [word for line in sample for word in line][:20_000]
        lines, owners = [], []
        for i, notices in enumerate(NOTICES.values()):
            for notice in notices:
                for words in variations(notice, rng, filler):
                    lines.append(words)
                    owners.append(i)
        # Lines of the corpus, and licence words out of their order.
        vocabulary = sorted({w for line in lines for w in line} - set(filler))
        lines += sample
        for _ in range(400):
            n = int(rng.integers(1, 15))
            lines.append([vocabulary[i] for i in rng.integers(0, len(vocabulary), n)])
        lines.append([])
        owners += [len(NOTICES)] * (len(lines) - len(owners))
        owner = np.asarray(owners)
        left_out = rng.random(len(lines)) < 0.2
        at, sizes = feature_rows(lines)
        dense = np.zeros((len(lines), DIMENSIONS), np.float32)
        np.add.at(dense, (np.repeat(np.arange(len(lines)), sizes), at), 1)
        dense /= np.sqrt(np.maximum(sizes, 1))[:, None]
        target = np.eye(len(self.classes), dtype=np.float32)[owner]
        weights = np.zeros((DIMENSIONS, len(self.classes)), np.float32)
        bias = np.zeros(len(self.classes), np.float32)
        x, y = dense[~left_out], target[~left_out]
        balance = (1 / np.maximum(y.sum(0), 1))[owner[~left_out]][:, None] * len(y) / len(self.classes)
        speed = np.zeros_like(weights)
        for _ in range(STEPS):  # gradient descent with momentum
            scores = x @ weights + bias
            scores -= scores.max(1, keepdims=True)
            chance = np.exp(scores)
            chance /= chance.sum(1, keepdims=True)
            error = (chance - y) * balance / len(y)
            speed = 0.9 * speed - 4.0 * (x.T @ error + 1e-5 * weights)
            weights += speed
            bias -= 4.0 * error.sum(0)
        held, truth = dense[left_out] @ weights + bias, owner[left_out]

        def loss(temperature: float) -> float:
            scaled = held / temperature
            scaled = scaled - scaled.max(1, keepdims=True)
            norm = np.log(np.exp(scaled).sum(1))
            return float((norm - scaled[np.arange(len(truth)), truth]).mean())

        self.temperature = min((t / 10 for t in range(3, 51)), key=loss)
        self.held_accuracy = float((held.argmax(1) == truth).mean())
        self.weights, self.bias = weights.astype(np.float64), bias.astype(np.float64)
        self.notices = {
            family: [pairs_of(line_words(n.encode())) for n in notices]
            for family, notices in NOTICES.items()
        }

    def classify(self, lines: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """The class and its calibrated probability of each line."""
        scores = logits(lines, self.weights, self.bias) / self.temperature
        scores -= scores.max(1, keepdims=True)
        chance = np.exp(scores)
        chance /= chance.sum(1, keepdims=True)
        best = chance.argmax(1)
        return best, chance[np.arange(len(lines)), best]

    def overlap(self, family: str, words: list[bytes]) -> float:
        """The largest share of a notice's word pairs that ``words`` holds, numbers alike."""
        own = pairs_of(words)
        return max(len(own & pairs) / len(pairs) for pairs in self.notices[family])


def pairs_of(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    plain = [b"0" if word.isdigit() else word for word in words]
    return set(zip(plain, plain[1:]))


def windows(lines: list[tuple[int, list[bytes]]]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Windows with an anchor: the line of each word, and the words.

    ``lines`` are numbered lines with words; a number left out is a blank line.
    """
    begin = 0
    for at in range(1, len(lines) + 1):
        if at < len(lines) and lines[at][0] == lines[at - 1][0] + 1:
            continue
        paragraph, begin = lines[begin:at], at
        words = [word for _, line in paragraph for word in line]
        anchors = [i for i, word in enumerate(words) if word in ANCHORS]
        if not anchors or len(paragraph) == 1 and len(words) <= WINDOWS[0][0]:
            continue
        places = [number for number, line in paragraph for _ in line]
        for size, step in WINDOWS:
            starts = {
                start
                for i in anchors
                for start in range(max(0, (i - size) // step + 1) * step, i + 1, step)
            }
            for start in sorted(starts):
                yield places[start : start + size], words[start : start + size]


def notice_place(words: list[bytes], notices: list[set]) -> tuple[float, int]:
    """The largest share of a long notice's word pairs, and the word at which it begins."""
    plain = [b"0" if word.isdigit() else word for word in words]
    pairs = list(zip(plain, plain[1:]))
    best = (0.0, 0)
    for notice in notices:
        share = len(notice.intersection(pairs)) / len(notice)
        if share > best[0] and len(notice) >= LONG_PAIRS:
            span = len(notice)
            held = [len(notice.intersection(pairs[o : o + span])) for o in range(len(pairs))]
            start = held.index(max(held))
            start += next(k for k, pair in enumerate(pairs[start:]) if pair in notice)
            best = (share, start)
    return best


def _scan(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 128):
                batch = whole.slice(begin, 128)
                owners, numbers, lines = [], [], []
                wide: list[tuple[int, list[int], list[bytes]]] = []
                for row, text in enumerate(batch.column("_text")):
                    first = len(lines)
                    for number, line in enumerate((text.as_py() or b"").split(b"\n")):
                        words = line_words(line)
                        if words:
                            owners.append(row)
                            numbers.append(number)
                            lines.append(words)
                    wide += [(row, *w) for w in windows(list(zip(numbers[first:], lines[first:])))]
                # (row, line, family): probability, overlap
                found: dict[tuple[int, int, str], tuple[float, float]] = {}
                if lines:
                    best, chance = model.classify(lines)
                    hit = (best < len(NOTICES)) & (chance >= LEAST_PROBABILITY)
                    for i in np.flatnonzero(hit).tolist():
                        family = model.classes[best[i]]
                        overlap = model.overlap(family, lines[i])
                        found[owners[i], numbers[i], family] = (float(chance[i]), overlap)
                if wide:
                    confirmed = {key for key, (_, share) in found.items() if share >= LEAST_OVERLAP}
                    best, chance = model.classify([words for _, _, words in wide])
                    hit = (best < len(NOTICES)) & (chance >= LEAST_PROBABILITY)
                    for i in np.flatnonzero(hit).tolist():
                        row, places, words = wide[i]
                        family = model.classes[best[i]]
                        overlap, start = notice_place(words, model.notices[family])
                        if overlap < LEAST_OVERLAP or any((row, n, family) in confirmed for n in places):
                            continue
                        key = (row, places[start], family)
                        if key not in found or found[key][1] < overlap:
                            found[key] = (float(chance[i]), overlap)
                out: dict[str, list] = {
                    n: [] for n in ("_id", "line", "family", "probability", "overlap", "confirmed")
                }
                for (row, number, family), (probability, overlap) in sorted(found.items()):
                    out["_id"].append(batch.column("_id")[row].as_py())
                    out["line"].append(number)
                    out["family"].append(family)
                    out["probability"].append(probability)
                    out["overlap"].append(overlap)
                    out["confirmed"].append(overlap >= LEAST_OVERLAP)
                yield pa.RecordBatch.from_pydict(
                    out,
                    schema=pa.schema(
                        [
                            ("_id", pa.int64()),
                            ("line", pa.int32()),
                            ("family", pa.string()),
                            ("probability", pa.float64()),
                            ("overlap", pa.float64()),
                            ("confirmed", pa.bool_()),
                        ]
                    ),
                )

    return run


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to three lines of each text, spread over it, that name no licence."""
    named = re.compile(_NAMED.encode())
    for batch in batches:
        found = []
        for text in batch.column("_text"):
            lines = [line for line in (text.as_py() or b"").split(b"\n") if line.strip()]
            for line in lines[:: max(1, -(-len(lines) // 3))]:
                if not named.search(line):
                    found.append(line)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["line"])


def train(rows: DataFrame, sample_lines: int = SAMPLE_LINES) -> Classifier:
    """Fitted on the notices and at most ``sample_lines`` lines of ``rows`` (``_row, _text``)."""
    n = rows.count()
    share = min(1.0, sample_lines / max(n, 1))
    drawn = rows.where(F.pmod(F.col("_row"), F.lit(1_000_003)) < share * 1_000_003)
    lines = stage(drawn.select("_text").mapInArrow(_drawn, "line binary"), "lines")
    found = lines.orderBy(F.xxhash64("line")).limit(sample_lines).collect()
    return Classifier([line_words(bytes(row["line"])) for row in found])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, line, family, probability, overlap, confirmed`` for each licence paragraph.

    ``line`` counts lines from zero; a notice over several lines has the line it
    begins on.  Only paragraphs that the classifier gives
    to a family with ``LEAST_PROBABILITY`` or more have a row; ``confirmed`` says
    whether the comparison with the notices bears it out.  Null and empty texts
    have none; repeated rows have theirs each; null ids are kept; other columns
    don't matter; an empty table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col).withColumn("_id", F.col("_id").cast("long"))
    model = train(rows)
    return rows.select("_id", "_text").mapInArrow(
        _scan(model),
        "_id long, line int, family string, probability double, overlap double, confirmed boolean",
    ).withColumnRenamed("_id", id_col)
