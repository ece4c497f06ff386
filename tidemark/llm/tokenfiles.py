"""Token ids as ORC files.

Documents are range partitioned by id and sorted, encoded where they land and
written at once, one file per partition: ids are a list of integers, which ORC
stores in run-length encoded stripes; the stripes have row indexes, and Bloom
filters on the document id.  Each row also bears its length and its place
within its file, so the place within the whole corpus needs the files' totals
alone, and stripes can be read in parallel and in any order.  A filter on ids skips files and
stripes by their statistics, row groups by the index and the Bloom filter.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.frames import join_rows, keyed
from tidemark.session import scratch_path

END_ID = 2
#: Words that a worker keeps in each of two generations; results don't depend on it.
MEMO_ENTRIES = 500_000
#: Bytes of text encoded at a time, if they are of several texts.
SLICE_BYTES = 8 << 20

#: Settings of the files: stripes, rows per index entry, Bloom filters.
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "10000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}

#: White space before a space or line end: such texts are encoded whole.
_RUNS = (
    r"[\x{00}-\x{20}\x{7f}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}"
    r"\x{205f}-\x{206f}\x{3000}\x{feff}][ \n]"
)


class Encoder:
    """Ids of texts, with the encodings of single words kept.

    Byte-level pre-tokenisation always starts a new piece at a space or line end
    that follows something else, so what lies between can be encoded by itself.
    That is tested on loading; a tokenizer for which it doesn't hold encodes
    whole texts.  The texts of a slice are cut into words by Arrow; each
    distinct word is looked up once, and those not known are encoded together,
    as one text of words with a space before each: a token that begins with a
    space begins the next word.  Of the words kept, those of the last but one
    generation go when the last one is full.
    """

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        first = spec.get("pre_tokenizer") or {}
        self.by_word = (
            first.get("type") == "ByteLevel"
            and first.get("use_regex", True)
            and not first.get("add_prefix_space")
            and spec.get("normalizer") is None
            and spec.get("truncation") is None
            and not any(" " in t["content"] or "\n" in t["content"] or t["lstrip"] or t["rstrip"]
                        for t in spec.get("added_tokens", []))
        )
        size = self.library.get_vocab_size(with_added_tokens=True)
        # Byte-level vocabularies write a space as this letter.
        self.begins = np.array([(self.library.id_to_token(i) or "").startswith("\u0120") for i in range(size)])

    def _pack(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in found]

    def _pack_words(self, words: list[str]) -> list[bytes]:
        """Ids of words after a space, or after the line end that they begin with."""
        packed: list[bytes] = []
        for begin in range(0, len(words), 4096):
            some = words[begin : begin + 4096]
            joined = " " + " ".join(some)
            together = None
            # No other white space in them, and none empty.
            if joined.split() == some:
                ids = np.frombuffer(self._pack([joined])[0], np.uint32)
                starts = np.flatnonzero(self.begins[ids])
                if len(starts) == len(some) and starts[0] == 0:
                    ends = [*(4 * starts[1:]).tolist(), 4 * len(ids)]
                    whole = ids.tobytes()
                    together = [whole[a:b] for a, b in zip((4 * starts).tolist(), ends)]
            packed += together or self._pack([w if w[:1] == "\n" else " " + w for w in some])
        return packed

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, encoding those not met lately."""
        young, old = self.young, self.old
        found = list(map(young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new: list[int] = []
        for i in missing:
            ids = old.get(words[i])
            if ids is None:
                new.append(i)
            else:
                found[i] = young[words[i]] = ids
        plain = [i for i in new if words[i][:1] > " "]
        rest = [i for i in new if words[i][:1] <= " "]
        for places in (plain, rest):
            for i, ids in zip(places, self._pack_words([words[i] for i in places])):
                found[i] = young[words[i]] = ids
        if len(young) > MEMO_ENTRIES:
            self.young, self.old = {}, young
        return found

    def _by_words(self, texts: pa.StringArray) -> pa.ListArray:
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = np.asarray(cut.offsets)
        words = cut.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        places = np.array(words.indices, np.int64)
        # A text's first word has no space before it.
        starts = offsets[:-1] - offsets[0]
        firsts, own = np.unique(places[starts], return_inverse=True)
        places[starts] = len(distinct) + own
        used = np.zeros(len(distinct), bool)
        used[places[places < len(distinct)]] = True
        found: list[bytes] = [b""] * len(distinct)
        at = np.flatnonzero(used).tolist()
        for i, ids in zip(at, self._known([distinct[i] for i in at])):
            found[i] = ids
        found += self._pack([distinct[i] for i in firsts])
        sizes = np.array(list(map(len, found)), np.int64) // 4
        ids = pa.ListArray.from_arrays(
            pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()),
            pa.array(np.frombuffer(b"".join(found), np.int32)),
        )
        ends = np.r_[0, np.cumsum(sizes[places])][offsets - offsets[0]]
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), ids.take(pa.array(places)).flatten()
        )

    def encode_array(self, texts: pa.StringArray) -> pa.ListArray:
        """The ids of each text."""
        if not len(texts):
            return pa.array([], pa.list_(pa.int32()))
        apart = np.full(len(texts), not self.by_word)
        if self.by_word:
            apart = np.array(pc.match_substring_regex(texts, _RUNS))
        if not apart.any():
            return self._by_words(texts)
        whole = np.flatnonzero(apart)
        packed = self._pack([texts[int(i)].as_py() for i in whole])
        sizes = [len(ids) // 4 for ids in packed]
        one = pa.ListArray.from_arrays(
            pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()),
            pa.array(np.frombuffer(b"".join(packed), np.int32)),
        )
        if len(whole) == len(texts):
            return one
        other = self._by_words(texts.take(pa.array(np.flatnonzero(~apart))))
        order = np.argsort(np.r_[whole, np.flatnonzero(~apart)], kind="stable")
        return pa.concat_arrays([one, other]).take(pa.array(order))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, as 32-bit integers in the machine's order."""
        ids = self.encode_array(pa.array(texts, pa.string()))
        offsets, flat = np.asarray(ids.offsets), np.asarray(ids.values)
        return [flat[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Neighbours of so many bytes together, or one that has more."""
    ends, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        before = ends[begin] - sizes[begin]
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield slice(begin, end)
        begin = end


def _strings(texts: pa.BinaryArray) -> pa.StringArray:
    """Texts of bytes; what is not UTF-8 is replaced, a missing text is empty."""
    try:
        return pc.fill_null(texts.cast(pa.string()), "")
    except pa.ArrowInvalid:
        return pa.array([(t.as_py() or b"").decode("utf-8", "replace") for t in texts], pa.string())


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = encoder(path)
        before = 0
        for whole in batches:
            lengths = pc.fill_null(pc.binary_length(whole.column("_text")), 0)
            for part in _slices(np.asarray(lengths).astype(np.int64)):
                batch = whole.slice(part.start, part.stop - part.start)
                ids = library.encode_array(_strings(batch.column("_text")))
                ends = np.asarray(ids.offsets).astype(np.int64)
                flat = np.insert(np.asarray(ids.values), ends[1:], end_id)
                offsets = ends + np.arange(len(ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_id"),
                        pa.array(before + offsets[:-1]),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    ],
                    names=["doc_id", "place", "n", "ids"],
                )
                before += int(offsets[-1])

    return run


def write(
    docs: DataFrame,
    tokenizer_path: str,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
) -> str:
    """Encodes every whole text and writes the files; returns their folder.

    Files and the rows in them are in ascending id order (null ids first; rows
    that repeat an id by a hash of their text).  A null or empty text has the
    end id alone.  Other columns don't matter.  An empty table gives a folder
    without rows.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    rows = keyed(docs, id_col, text_col).withColumn("_id", F.col("_id").cast("long"))
    ordered = rows.repartitionByRange("_id", "_row").sortWithinPartitions("_id", "_row")
    ids = ordered.select("_id", "_text").mapInArrow(
        _encode(tokenizer_path, end_id), "doc_id long, place long, n long, ids array<int>"
    )
    ids.write.options(**ORC_OPTIONS).orc(path)
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids``: ``start`` counts the ids of all documents before."""
    rows = spark.read.schema("doc_id long, place long, n long, ids array<int>").orc(path)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    rows = rows.select("doc_id", "place", "n", "ids", number.alias("_file"))
    # Reads two columns of numbers, not the ids.
    totals = rows.groupBy("_file").agg(F.max(F.col("place") + F.col("n")).alias("n"))
    # One row per file.
    order = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_file", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_before"))
    return join_rows(rows, before, ["_file"], "inner").select(
        "doc_id", (F.col("_before") + F.col("place")).alias("start"), "ids"
    )


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """``doc_id, ids`` of some documents; files, stripes and row groups without them are skipped."""
    rows = spark.read.schema("doc_id long, place long, ids array<int>").orc(path)
    return rows.where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
        ends = ids.offsets.to_numpy()
        sizes = np.diff(ends)
        checks = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("start"),
                pa.array(sizes.astype(np.int64)),
                pa.array(checks, pa.int64()),
            ],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the files."""
    return read(spark, path).mapInArrow(
        _digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
