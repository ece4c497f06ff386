"""SimHash near-dedup over Golay codes.

Fingerprints take 64 bits.  Candidates: the 64 bits are three segments, each
read as a word of the binary Golay code of length 23 (zeros on top).  The code
is perfect, so each word decodes to one codeword within three bits.  Words one
bit apart share the codeword of either, if the other also lists the codewords
of its one-bit neighbours.  With at most three differing bits, two of the three
segments differ in at most one bit each (pigeonhole), so for each pair of
segments a document files itself under (own codeword, listed codewords) and
(listed codewords, own codeword): those two meet in a bucket of 24 key bits.
Every pair within the radius shares a bucket; every pair of a bucket is
verified bit by bit.

Buckets don't emit all their pairs: a bucket gives the links of a spanning
forest, which is all that components need.  Equal fingerprints are one node.
A bucket of more than ``BUCKET_NODES`` nodes is dealt out again by bits that a
linked pair must share in one of twelve ways.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.components import components
from tidemark.llm.frames import keyed, without
from tidemark.llm.workers import tidy
from tidemark.session import stage

_OWNER = "simhash"
SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Nodes of one bucket that a task links together.
BUCKET_NODES = 1 << 14
#: Up to this size a bucket's pairs are compared side by side.
SMALL_BUCKET = 8

#: Generator polynomial of the binary Golay code, its length, its data bits.
GOLAY_POLYNOMIAL = 0b101011100011
GOLAY_LENGTH = 23
GOLAY_DATA = 12

_SEGMENTS = ((0, 22), (22, 21), (43, 21))
_PAIRS = ((0, 1), (0, 2), (1, 2))


def _remainder(word: int) -> int:
    for bit in range(GOLAY_LENGTH - 1, GOLAY_LENGTH - GOLAY_DATA - 1, -1):
        if word >> bit & 1:
            word ^= GOLAY_POLYNOMIAL << (bit - (GOLAY_LENGTH - GOLAY_DATA))
    return word


class Golay:
    """Decoding by syndrome, for arrays of words."""

    def __init__(self) -> None:
        unit = [_remainder(1 << bit) for bit in range(GOLAY_LENGTH)]
        self.tables = np.zeros((3, 256), np.int64)
        for part in range(3):
            for byte in range(256):
                for bit in range(8):
                    if byte >> bit & 1 and 8 * part + bit < GOLAY_LENGTH:
                        self.tables[part, byte] ^= unit[8 * part + bit]
        self.leader = np.zeros(1 << (GOLAY_LENGTH - GOLAY_DATA), np.int64)
        for weight in (1, 2, 3):
            for bits in combinations(range(GOLAY_LENGTH), weight):
                syndrome = error = 0
                for bit in bits:
                    syndrome ^= unit[bit]
                    error |= 1 << bit
                self.leader[syndrome] = error

    def index(self, words: np.ndarray) -> np.ndarray:
        """The data bits of the nearest codeword."""
        syndrome = (
            self.tables[0, words & 255]
            ^ self.tables[1, words >> 8 & 255]
            ^ self.tables[2, words >> 16 & 255]
        )
        return (words ^ self.leader[syndrome]) >> (GOLAY_LENGTH - GOLAY_DATA)


def fingerprint(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of all shingles, repeats included."""
    import xxhash

    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-1]]
    take = min(shingle, len(words))
    n = len(words) - take + 1
    digest = xxhash.xxh64_intdigest
    codes = np.fromiter(
        (
            digest(joined[a:b], SEED)
            for a, b in zip(starts[:n].tolist(), (ends[take - 1 :] - 1).tolist())
        ),
        np.uint64,
        n,
    )
    counts = np.zeros(64, np.int64)
    for begin in range(0, n, 1 << 15):
        part = codes[begin : begin + (1 << 15)].astype("<u8").view(np.uint8)
        counts += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(text.as_py(), shingle) for text in batch.column(1)),
                np.uint64,
                batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["_id", "fp"]
            )

    return run


def bucket_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for every bucket of every fingerprint."""
    code = Golay()
    own, near = [], []
    for shift, width in _SEGMENTS:
        word = (prints >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
        nearest = code.index(word)
        listed = np.stack([nearest, *(code.index(word ^ (1 << bit)) for bit in range(width))], 1)
        listed.sort(axis=1)
        fresh = np.ones(listed.shape, bool)
        fresh[:, 1:] = listed[:, 1:] != listed[:, :-1]
        own.append(nearest)
        near.append((listed, fresh))
    rows, keys = [], []
    for pair, (i, j) in enumerate(_PAIRS):
        for first, (listed, fresh) in ((True, near[j]), (False, near[i])):
            row, at = np.nonzero(fresh)
            other = listed[row, at]
            if first:
                key = own[i][row] << GOLAY_DATA | other
            else:
                keep = other != own[i][row]  # (own, own) is there already
                row, other = row[keep], other[keep]
                key = other << GOLAY_DATA | own[j][row]
            rows.append(row)
            keys.append(key | pair << 2 * GOLAY_DATA)
    return np.concatenate(rows), np.concatenate(keys)


def sub_keys(prints: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) that split a bucket: linked pairs agree in one of 3 x 4 blocks.

    The pair of segments that made the key differs in two bits at most, so one
    of three blocks of it is equal; the segment left over differs in three at
    most, so one of four blocks of it is.
    """
    from tidemark.llm.words import mix

    rows, out = [], []
    for pair, (i, j) in enumerate(_PAIRS):
        row = np.flatnonzero(keys >> 2 * GOLAY_DATA == pair)
        left = ({0, 1, 2} - {i, j}).pop()
        parts = []
        for segment in (i, j, left):
            shift, width = _SEGMENTS[segment]
            parts.append(
                (prints[row] >> np.uint64(shift)).astype(np.int64) & ((1 << width) - 1)
            )
        joined = parts[0] << _SEGMENTS[j][1] | parts[1]
        for a in range(3):
            block = joined >> 15 * a & 0x7FFF
            for b in range(4):
                rest = parts[2] >> 6 * b & 0x3F
                packed = (block << 6 | rest) << 4 | (a * 4 + b)
                with np.errstate(over="ignore"):
                    mixed = mix(packed.astype(np.uint64)) ^ mix(
                        keys[row].astype(np.uint64) + np.uint64(1)
                    )
                rows.append(row)
                out.append(mix(mixed).view(np.int64))
    return np.concatenate(rows), np.concatenate(out)


def _expand(split):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 4096) for i in range(0, batch.num_rows, 4096)):
                nodes = part.column("node").to_numpy(zero_copy_only=False)
                prints = part.column("fp").to_numpy(zero_copy_only=False)
                if split:
                    keys = part.column("key").to_numpy(zero_copy_only=False)
                    rows, found = sub_keys(prints.view(np.uint64), keys)
                else:
                    rows, found = bucket_keys(prints.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), pa.array(nodes[rows]), pa.array(prints[rows])],
                    names=["key", "node", "fp"],
                )

    return run


def forest(nodes: np.ndarray, prints: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that join what is linked, by search from node to node.

    Each node is compared once with those not reached so far, so a dense bucket
    costs little more than its size.
    """
    links = []
    left = np.arange(len(nodes))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            close = np.bitwise_count(prints[left] ^ prints[at]) <= bits
            if close.any():
                found = left[close]
                left = left[~close]
                links.extend((int(nodes[at]), int(nodes[x])) for x in found)
                queue.extend(found)
    return links


def _links(bits: int, most: int | None):
    """Links of buckets that come sorted by key; buckets over ``most`` come back whole."""

    def solve(keys, nodes, prints):
        small: list[np.ndarray] = []
        cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
        sizes = np.diff(cuts)
        few = np.repeat(sizes <= SMALL_BUCKET, sizes)
        for step in range(1, SMALL_BUCKET):
            if len(keys) <= step:
                break
            same = (keys[step:] == keys[:-step]) & few[step:]
            at = np.flatnonzero(same)
            if not len(at):
                break
            at = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= bits]
            if len(at):
                small.append(np.stack([nodes[at], nodes[at + step]], 1))
        large: list[tuple[int, int]] = []
        for group in np.flatnonzero(sizes > SMALL_BUCKET).tolist():
            part = slice(cuts[group], cuts[group + 1])
            large.extend(forest(nodes[part], prints[part], bits))
        if large:
            small.append(np.asarray(large, np.int64).reshape(-1, 2))
        found = np.unique(np.concatenate(small), axis=0) if small else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(found), pa.int64()), pa.array(found[:, 0]), pa.array(found[:, 1])],
            names=["key", "a", "b"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]
        over: int | None = None
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            new[2] = new[2].view(np.uint64)
            if over is not None:  # the rest of a bucket that is too large
                n = int(np.searchsorted(new[0], over, "right"))
                if n:
                    yield _back(*(x[:n] for x in new))
                new = [x[n:] for x in new]
                if not len(new[0]):
                    continue
                over = None
            held = [np.concatenate(pair) for pair in zip(held, new)]
            if not len(held[0]):
                continue
            begin = int(np.searchsorted(held[0], held[0][-1], "left"))
            yield from _whole(*(x[:begin] for x in held))
            held = [x[begin:] for x in held]
            if most is not None and len(held[0]) > most:
                over = int(held[0][-1])
                yield _back(*held)
                held = [x[:0] for x in held]
        yield from _whole(*held)

    def _whole(keys, nodes, prints):
        if not len(keys):
            return
        if most is not None:
            cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
            big = np.repeat(np.diff(cuts) > most, np.diff(cuts))
            if big.any():
                yield _back(keys[big], nodes[big], prints[big])
                keys, nodes, prints = keys[~big], nodes[~big], prints[~big]
        if len(keys):
            yield solve(keys, nodes, prints)

    def _back(keys, nodes, prints):
        return pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(nodes), pa.array(prints.view(np.int64))],
            names=["key", "a", "b"],
        )

    return run


def links(prints: DataFrame, bits: int = MAX_BITS, bucket_nodes: int = BUCKET_NODES) -> DataFrame:
    """``a, b``: links that join all nodes whose fingerprints lie within ``bits``.

    ``prints`` has ``node`` and ``fp``, each fingerprint once.
    """
    if not 0 <= bits <= MAX_BITS:
        raise ValueError("the keys reach all pairs up to three bits apart, not beyond")

    def buckets(rows: DataFrame, split: bool) -> DataFrame:
        keyed_rows = rows.mapInArrow(tidy(_OWNER, _expand(split)), "key long, node long, fp long")
        return keyed_rows.repartition("key").sortWithinPartitions("key", "fp")

    found = stage(
        buckets(prints.select("node", "fp"), False).mapInArrow(
            tidy(_OWNER, _links(bits, bucket_nodes)), "key long, a long, b long"
        ),
        "links",
    )
    straight = found.where("key is null").select("a", "b")
    large = found.where("key is not null")
    if large.take(1):
        again = large.select("key", F.col("a").alias("node"), F.col("b").alias("fp"))
        more = buckets(again, True).mapInArrow(
            tidy(_OWNER, _links(bits, None)), "key long, a long, b long"
        )
        straight = straight.union(more.select("a", "b"))
    return straight


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """``_id, fp`` (signed 64 bits) of every row's whole text."""
    rows = keyed(docs, id_col, text_col).select(F.col("_id").cast("long").alias("_id"), "_text")
    return rows.mapInArrow(tidy(_OWNER, _fingerprints(shingle)), "_id long, fp long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
    bucket_nodes: int = BUCKET_NODES,
) -> DataFrame:
    """``id_col, fingerprint, component_id`` for every row.

    The component is the least id that links reach, the row's own included.
    Null and empty texts and texts without a word have fingerprint zero and are
    linked like any other.  A row that repeats an id is judged by its own text;
    a row with a null id gets its component from the others, or null if there
    are none.  Other columns don't matter.  An empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "prints")
    nodes = stage(rows.groupBy("fp").agg(F.min("_id").alias("node")), "nodes")
    found = links(nodes.where("node is not null"), bits, bucket_nodes)
    parts = components(found, "a", "b")
    of_print = nodes.join(parts, "node", "left").select(
        "fp", F.coalesce("component", "node").alias("component_id")
    )
    return rows.join(of_print, "fp").select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of the document with the least id of each component, all columns kept.

    Rows that repeat an id stay or go together; rows with a null id stay.
    """
    found = near_duplicates(docs, id_col, text_col, shingle, bits)
    gone = found.where(F.col("component_id") < F.col(id_col)).select(id_col)
    return without(docs, gone, [F.col(f"`{id_col}`").cast("long")])
