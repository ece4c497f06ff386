"""Substring dedup over super-k-mers.

Windows of ``width`` words are grouped by their minimiser, the least hash of
the runs of ``seed`` words in them.  Neighbouring windows that share it form a
super-k-mer.  A window that occurs twice has the same minimiser both times, so
a minimiser seen in one document alone rules its windows out before any text
travels.  The others go, as one packed string for the whole super-k-mer, to the
minimiser's bucket; equal strings are folded first, and in the bucket the
windows are sorted and compared word for word.

Steps: 1. minimisers of all documents, staged as numbers; 2. those of two or
more documents; 3. their super-k-mers cut from the texts; 4. buckets; 5. words
to remove, per document.  A bucket of more than ``BUCKET_STRINGS`` different
strings is dealt out again by window, so no task holds a hot passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.frames import in_order_runs, join_rows, keyed, unused
from tidemark.llm.words import hashes, runs_of, sliding_min, split
from tidemark.llm.workers import tidy
from tidemark.session import stage

WIDTH = 50
SEED_WORDS = 8
#: Different strings of one minimiser that a task sorts together (about 30 MB).
BUCKET_STRINGS = 1 << 16

_OWNER = "substrings"
_KMERS = "mini long, _id long, _row long, start int, n int"
#: Occurrences have no ``packed``; strings, one of each per batch, have no ``_row``.
_PIECES = "mini long, sig long, _id long, _row long, start int, packed binary"
_FIRSTS = "mini long, sig long, firsts array<long>"
_KEPT = "_id long, _row long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def _kmers(width: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[np.ndarray]] = [[], [], [], [], []]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows = batch.column(1).to_numpy(zero_copy_only=False)
            for at, text in enumerate(batch.column(2)):
                words = split(text.as_py())
                if len(words) < width:
                    continue
                least = sliding_min(runs_of(hashes(words), seed), width - seed + 1)
                starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
                parts[0].append(least[starts].view(np.int64))
                parts[1].append(np.full(len(starts), ids[at], np.int64))
                parts[2].append(np.full(len(starts), rows[at], np.int64))
                parts[3].append(starts.astype(np.int32))
                parts[4].append(np.diff(np.r_[starts, len(least)]).astype(np.int32))
            if parts[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(part)) for part in parts],
                    names=["mini", "_id", "_row", "start", "n"],
                )

    return run


def _pieces(width: int):
    schema = pa.schema(
        [
            ("mini", pa.int64()),
            ("sig", pa.int64()),
            ("_id", pa.int64()),
            ("_row", pa.int64()),
            ("start", pa.int32()),
            ("packed", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows: list[tuple] = []
            strings: dict[tuple[int, bytes], tuple[int, int]] = {}
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                words, doc = split(one["_text"]), one["_id"]
                for mini, span in zip(one["minis"], one["spans"]):
                    start, n = span >> 32, span & 0xFFFFFFFF
                    packed = b" ".join(words[start : start + n + width - 1])
                    sig = xxhash.xxh3_64_intdigest(packed) - (1 << 63)
                    rows.append((mini, sig, doc, one["_row"], start, None))
                    _, least = strings.get((mini, packed), (sig, doc))
                    strings[mini, packed] = sig, min(least, doc)
            rows += [(m, sig, doc, None, None, p) for (m, p), (sig, doc) in strings.items()]
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(columns, schema)],
                schema=schema,
            )

    return run


def windows_of(packed: bytes, width: int) -> list[bytes]:
    """The windows of a packed string, as slices of it."""
    words = packed.split(b" ")
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-1]]
    n = len(words) - width + 1
    return [
        packed[a:b]
        for a, b in zip(starts[:n].tolist(), (ends[width - 1 :] - 1).tolist())
    ]


def _bucket(width: int):
    """For each string the least document of each of its windows, by sorting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_order_runs(batches, "mini"):
            minis = table.column("mini").to_numpy()
            sigs = table.column("sig").to_numpy()
            docs = table.column("_id").to_numpy()
            packed = table.column("packed").combine_chunks()
            cuts = np.flatnonzero(np.r_[True, minis[1:] != minis[:-1], True])
            firsts: list[np.ndarray] = []
            for begin, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                owned: list[tuple[bytes, int, int, int]] = []
                sizes = []
                for row in range(begin, end):
                    found = windows_of(packed[row].as_py(), width)
                    sizes.append(len(found))
                    doc = int(docs[row])
                    owned.extend((w, doc, row - begin, at) for at, w in enumerate(found))
                owned.sort()
                least = [np.empty(size, np.int64) for size in sizes]
                previous, doc_of = None, 0
                for window, doc, row, at in owned:
                    if window != previous:
                        previous, doc_of = window, doc
                    least[row][at] = doc_of
                firsts.extend(least)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(minis),
                    pa.array(sigs),
                    pa.array(firsts, pa.list_(pa.int64())),
                ],
                names=["mini", "sig", "firsts"],
            )

    return run


def _dealt(width: int):
    """One row per window of the strings of hot buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                windows = windows_of(batch.column("packed")[row].as_py(), width)
                n = len(windows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("mini")[row].as_py()] * n, pa.int64()),
                        pa.array([batch.column("sig")[row].as_py()] * n, pa.int64()),
                        pa.array([batch.column("_id")[row].as_py()] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array([hashlib.sha256(w).digest() for w in windows], pa.binary()),
                    ],
                    names=["mini", "sig", "_id", "at", "window"],
                )

    return run


def kept_words(words: list[bytes], hits: list[int], width: int) -> list[bytes]:
    """The words that no window of the ranges ``hits`` covers."""
    change = np.zeros(len(words) + 1, np.int64)
    ranges = np.asarray(hits, np.int64)
    np.add.at(change, ranges >> 32, 1)
    np.add.at(change, (ranges & 0xFFFFFFFF) + width, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _apply(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {
                name: []
                for name in ("_id", "_row", "n_words", "n_removed", "kept_text", "kept_sha256")
            }
            for row in range(batch.num_rows):
                words = split(batch.column("_text")[row].as_py())
                total, hits = len(words), batch.column("hits")[row].as_py()
                if hits:
                    words = kept_words(words, hits, width)
                kept = b" ".join(words)
                out["_id"].append(batch.column("_id")[row].as_py())
                out["_row"].append(batch.column("_row")[row].as_py())
                out["n_words"].append(total)
                out["n_removed"].append(total - len(words))
                out["kept_text"].append(kept.decode("utf-8", "replace"))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [
                        ("_id", pa.int64()),
                        ("_row", pa.int64()),
                        ("n_words", pa.int64()),
                        ("n_removed", pa.int64()),
                        ("kept_text", pa.string()),
                        ("kept_sha256", pa.string()),
                    ]
                ),
            )

    return run


def window_hits(
    docs: DataFrame, width: int, seed: int, bucket_strings: int = BUCKET_STRINGS
) -> DataFrame:
    """``_id, _row, hits``: the windows that a smaller id also holds.

    ``hits`` are ranges of windows, first and last in one number.  ``docs`` has
    ``_id``, ``_row`` and ``_text``; rows without such a window are absent.
    """
    kmers = stage(docs.mapInArrow(tidy(_OWNER, _kmers(width, seed)), _KMERS), "kmers")
    shared = (
        kmers.groupBy("mini")
        .agg(F.min("_id").alias("low"), F.max("_id").alias("high"))
        .where("low < high")
        .select("mini")
    )
    wanted = (
        kmers.join(shared, "mini")
        .groupBy("_id", "_row")
        .agg(F.collect_set(F.struct("mini", _pair(F.col("start"), F.col("n")).alias("span"))).alias("p"))
        .select("_id", "_row", F.col("p.mini").alias("minis"), F.col("p.span").alias("spans"))
    )
    pieces = stage(
        join_rows(docs, wanted, ["_id", "_row"], "inner")
        .select("_id", "_row", "_text", "minis", "spans")
        .mapInArrow(tidy(_OWNER, _pieces(width)), _PIECES),
        "pieces",
    )
    sizes = pieces.where("packed is not null").groupBy("mini")
    hot = stage(
        sizes.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_strings).select("mini"),
        "hot",
    )
    some_hot = bool(hot.take(1))
    cold = pieces.where("packed is not null")
    if some_hot:
        cold = join_rows(cold, hot, ["mini"], "left_anti")
    firsts = (
        _folded(cold)
        .sortWithinPartitions("mini")
        .select("mini", "sig", "_id", "packed")
        .mapInArrow(tidy(_OWNER, _bucket(width)), _FIRSTS)
    )
    if some_hot:
        many = join_rows(pieces.where("packed is not null"), hot, ["mini"], "left_semi")
        dealt = _folded(many).select("mini", "sig", "_id", "packed").mapInArrow(
            tidy(_OWNER, _dealt(width)), "mini long, sig long, _id long, at int, window binary"
        )
        dealt = stage(dealt, "dealt")
        least = dealt.groupBy("window").agg(F.min("_id").alias("first"))
        firsts = firsts.unionByName(
            dealt.join(least, "window")
            .groupBy("mini", "sig")
            .agg(F.array_sort(F.collect_list(F.struct("at", "first"))).alias("all"))
            .select("mini", "sig", F.col("all.first").alias("firsts"))
        )
    hit = lambda at: F.coalesce(F.get("firsts", at) < F.col("_id"), F.lit(False))
    every = F.sequence(F.lit(0), F.size("firsts") - 1)
    runs = F.zip_with(
        F.filter(every, lambda at: hit(at) & ~hit(at - 1)),
        F.filter(every, lambda at: hit(at) & ~hit(at + 1)),
        lambda first, last: F.struct(
            (F.col("start") + first).alias("a"), (F.col("start") + last).alias("b")
        ),
    )
    found = (
        pieces.where("packed is null")
        .select("mini", "sig", "_id", "_row", "start")
        .join(firsts, ["mini", "sig"])
        .select("_id", "_row", runs.alias("runs"))
        .groupBy("_id", "_row")
        .agg(F.array_sort(F.flatten(F.collect_list("runs"))).alias("r"))
        .where(F.size("r") > 0)
    )
    # Runs of neighbouring pieces become one; those of repeated rows are equal.
    apart = lambda x, y: y["a"] > x["b"] + 1
    begins = F.transform(
        "r",
        lambda x, i: F.when((i == 0) | apart(F.get("r", i - 1), x), x["a"]),
    )
    ends = F.transform(
        "r",
        lambda x, i: F.when((i == F.size("r") - 1) | apart(x, F.get("r", i + 1)), x["b"]),
    )
    present = lambda x: x.isNotNull()
    merged = F.zip_with(F.filter(begins, present), F.filter(ends, present), _pair)
    return found.select("_id", "_row", merged.alias("hits"))


def _pair(high, low):
    """Two counts in one number."""
    return F.shiftleft(high.cast("long"), 32).bitwiseOR(low.cast("long"))


def _folded(strings: DataFrame) -> DataFrame:
    """Each string once with its least document; those of a minimiser in one partition.

    A task has folded its own copies before, so each adds a row at most.
    """
    return (
        strings.select("mini", "sig", "packed", "_id")
        .repartition("mini")
        .groupBy("mini", "sig", "packed")
        .agg(F.min("_id").alias("_id"))
    )


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    seed: int = SEED_WORDS,
    bucket_strings: int = BUCKET_STRINGS,
) -> DataFrame:
    """Words covered by a window that also starts in a document of a smaller id go.

    Returns one row per input row: ``id_col, n_words, n_removed, kept_text,
    kept_sha256``.  Windows are judged on the input.  A null text has no words
    and an empty kept text; a null id takes part with nothing removed from it;
    rows that repeat an id don't count against each other; texts shorter than
    ``width`` words stay whole.  Other columns don't matter, whatever their
    names.  An empty table gives an empty result.
    """
    if not 0 < seed <= width:
        raise ValueError("seed must lie between 1 and width")
    rows = keyed(docs, id_col, text_col).withColumn("_id", F.col("_id").cast("long"))
    hits = window_hits(rows.where("_id is not null"), width, seed, bucket_strings)
    kept = join_rows(rows, hits, ["_id", "_row"], "left").select("_id", "_row", "_text", "hits")
    return (
        kept.mapInArrow(tidy(_OWNER, _apply(width)), _KEPT)
        .withColumnRenamed("_id", id_col)
        .drop("_row")
    )


def cut_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    seed: int = SEED_WORDS,
    bucket_strings: int = BUCKET_STRINGS,
) -> DataFrame:
    """``docs`` with the words that :func:`remove_repeats` removes taken from ``text_col``.

    A text that loses nothing stays as it is, white space included; one that
    loses words has the others joined by single spaces; a row that loses all
    its words goes.
    """
    rows = keyed(docs, id_col, text_col).withColumn("_id", F.col("_id").cast("long"))
    hits = window_hits(rows.where("_id is not null"), width, seed, bucket_strings)
    names = docs.columns
    own, row, starts_ = (unused(docs, name) for name in ("_key0", "_key1", "_hits"))
    keys = {own: F.col(f"`{id_col}`").cast("long"), row: F.xxhash64(f"`{text_col}`")}
    hits = hits.withColumnsRenamed({"_id": own, "_row": row, "hits": starts_})
    marked = join_rows(docs.withColumns(keys), hits, [own, row], "left")
    marked = marked.select(*[F.col(f"`{name}`") for name in [*names, starts_]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = names.index(text_col)
        for batch in batches:
            texts, keep = [], []
            starts = batch.column(len(names))
            for row, text in enumerate(batch.column(place)):
                text, hit = text.as_py(), starts[row].as_py()
                if hit:
                    text = b" ".join(kept_words(split(text.encode()), hit, width)).decode()
                texts.append(text)
                keep.append(not hit or bool(text))
            columns = [batch.column(i) for i in range(len(names))]
            columns[place] = pa.array(texts, columns[place].type)
            yield pa.RecordBatch.from_arrays(columns, names=list(names)).filter(pa.array(keep))

    return marked.mapInArrow(tidy(_OWNER, run), docs.schema)
