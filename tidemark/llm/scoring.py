"""Language-model scores from a smoothed bigram backoff automaton.

States are histories (a word, or the start of a text) and the root.  A state has
an arc for each word seen after it and a failure arc to the root, whose arcs are
the words.  An arc weighs the interpolated probability with absolute discounts
by count (one, two, more), fitted to the counts of counts; the failure arc
weighs what the discounts set free; the root smooths by adding 0.1 to each
count.  A traversal from left to right takes the arc if there is one, else the
failure arc, and adds up logarithms; with bigrams the state after a word is that
word, so all documents of a block are traversed side by side in numpy.

The automaton grows with the corpus, so no task holds it.  Documents are packed
into blocks of bounded text.  A block asks for the arcs it has words for: its
bigrams with their training counts go to buckets by history, buckets sum them
and answer each block with the totals alone, in the order in which it asked.
Histories that make up a thousandth of a sample or more are dealt out by the
word that follows too; their sums, at most a thousand rows, are put together
afterwards.  Words are known by 64-bit hashes, followers of one history by 48
bits.  Counts travel in as few bytes as the largest of a list needs.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.frames import keyed
from tidemark.llm.words import hashes, mix
from tidemark.session import stage

#: Bytes of text after which a block is closed, and of packed text that a bucket
#: should get.
BLOCK_BYTES = 3 << 20
BUCKET_BYTES = 2 << 20
#: Added to each count at the root.
ADD = 0.1
#: About how many rows are looked at to find frequent histories, and how frequent
#: those are.
#: This decides how rows are dealt out and nothing else.
HEAVY_SAMPLE_ROWS = 2000
HEAVY_SHARE = 1 / 1000

START = np.uint64(0x5354415254)
END = np.uint64(0x454E44)
#: Bytes by which a history's followers are told apart.
_WIDTH = 6
_SHORT = np.uint64((1 << 8 * _WIDTH) - 1)

_ASKED = (
    "bucket int, block long, hist binary, sizes binary, words binary, counts binary"
)
_TOTALS = (
    "bucket int, block long, kind int, stats binary, totals binary"
)


def narrow(counts: np.ndarray) -> bytes:
    """Counts in the fewest bytes that hold the largest, after that number of bytes."""
    most = int(counts.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def widen(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<u{packed[0]}", offset=1).astype(np.int64)


class Tokens:
    """Tokens of a block's texts, and its bigrams in the order of the buckets."""

    def __init__(self, payload: bytes, buckets: int, heavy: np.ndarray) -> None:
        table = pa.ipc.open_stream(zlib.decompress(payload)).read_all()
        self.ids = table.column("_id")
        self.held = table.column("held").to_numpy(zero_copy_only=False).astype(bool)
        words, hist, sizes = [], [], []
        for text in table.column("_text"):
            found = hashes((text.as_py() or b"").lower().split())
            words.append(np.append(found, END))
            hist.append(np.concatenate([[START], found]).astype(np.uint64))
            sizes.append(len(found) + 1)
        self.sizes = np.asarray(sizes, np.int64)
        #: The place of each token's word among the histories; ends stand for starts.
        after = np.concatenate([np.append(h[1:], START) for h in hist])
        words = np.concatenate(words)
        self.train = np.repeat(~self.held, self.sizes)
        self.ends = words == END
        hist = np.concatenate(hist)
        self.hist, self.at = np.unique(hist, return_inverse=True)
        del hist
        self.word_at = np.searchsorted(self.hist, after)
        del after
        short = mix(words) & _SHORT
        order = np.lexsort((short, self.at))
        at, word = self.at[order], short[order]
        del words, short
        fresh = np.r_[True, (at[1:] != at[:-1]) | (word[1:] != word[:-1])]
        number = np.cumsum(fresh) - 1
        pair = np.empty(len(order), np.int64)
        pair[order] = number
        del number, order
        self.pair_hist, self.pair_word = at[fresh], word[fresh]
        counts = np.bincount(pair, self.train, minlength=len(self.pair_hist)).astype(np.uint32)
        bucket = bucket_of(self.hist[self.pair_hist], self.pair_word, buckets, heavy)
        by_bucket = np.argsort(bucket, kind="stable")
        place = np.empty(len(by_bucket), np.int64)
        place[by_bucket] = np.arange(len(by_bucket))
        self.pair = place[pair]
        self.pair_hist = self.pair_hist[by_bucket]
        self.pair_word = self.pair_word[by_bucket]
        self.counts = counts[by_bucket]
        self.bucket = bucket[by_bucket]
        #: Where the histories of a bucket begin.
        self.first = np.r_[
            True,
            (self.bucket[1:] != self.bucket[:-1]) | (self.pair_hist[1:] != self.pair_hist[:-1]),
        ]


def bucket_of(hist: np.ndarray, word: np.ndarray, buckets: int, heavy: np.ndarray) -> np.ndarray:
    spread = mix(hist)
    many = np.isin(hist, heavy)
    spread[many] = mix(spread[many] ^ word[many])
    return (spread % np.uint64(buckets)).astype(np.int32)


def _packs():
    schema = pa.schema([("_id", pa.int64()), ("held", pa.bool_()), ("_text", pa.binary())])

    def pack(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as writer:
            for part in rows:
                writer.write_batch(part.cast(schema) if part.schema != schema else part)
        payload = zlib.compress(sink.getvalue(), 1)
        block = uuid.uuid4().int >> 65  # blocks are written once, so chance does no harm
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([payload], pa.large_binary())],
            names=["block", "payload"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            lengths = np.fromiter(
                (len(text.as_py() or b"") for text in batch.column("_text")), np.int64, batch.num_rows
            )
            begin = 0
            for row, length in enumerate(lengths.tolist()):
                size += length + 64
                if size >= BLOCK_BYTES:
                    held.append(batch.slice(begin, row + 1 - begin))
                    yield pack(held)
                    held, size, begin = [], 0, row + 1
            if begin < batch.num_rows:
                held.append(batch.slice(begin))
        if held:
            yield pack(held)

    def typed(batches):
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(pa.binary())], names=["block", "payload"]
            )

    return typed


def _ask(buckets: int, heavy: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                tokens = Tokens(batch.column("payload")[row].as_py(), buckets, heavy)
                block = batch.column("block")[row].as_py()
                out: dict[str, list] = {
                    n: [] for n in ("bucket", "block", "hist", "sizes", "words", "counts")
                }
                cuts = np.flatnonzero(
                    np.r_[True, tokens.bucket[1:] != tokens.bucket[:-1], True]
                )
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                    starts = np.flatnonzero(tokens.first[a:b])
                    out["bucket"].append(int(tokens.bucket[a]))
                    out["block"].append(block)
                    out["hist"].append(tokens.hist[tokens.pair_hist[a + starts]].astype("<u8").tobytes())
                    out["sizes"].append(np.diff(np.r_[starts, b - a]).astype("<u4").tobytes())
                    short = tokens.pair_word[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)
                    out["words"].append(np.ascontiguousarray(short[:, :_WIDTH]).tobytes())
                    out["counts"].append(narrow(tokens.counts[a:b]))
                yield pa.RecordBatch.from_pydict(
                    out,
                    schema=pa.schema(
                        [("bucket", pa.int32()), ("block", pa.int64())]
                        + [(n, pa.binary()) for n in ("hist", "sizes", "words", "counts")]
                    ),
                )

    return run


def _totals(heavy: np.ndarray):
    """Sums of a bucket: the answer to each block, and the bucket's own figures."""
    from tidemark.llm.frames import in_order_runs

    schema = pa.schema(
        [("bucket", pa.int32()), ("block", pa.int64()), ("kind", pa.int32())]
        + [("stats", pa.binary()), ("totals", pa.binary())]
    )

    def solve(rows: pa.Table) -> pa.RecordBatch:
        hist, sizes, words, counts, ends = [], [], [], [], [[0, 0]]
        for row in range(rows.num_rows):
            hist.append(np.frombuffer(rows["hist"][row].as_py(), "<u8"))
            sizes.append(np.frombuffer(rows["sizes"][row].as_py(), "<u4"))
            short = np.frombuffer(rows["words"][row].as_py(), np.uint8).reshape(-1, _WIDTH)
            word = np.zeros((len(short), 8), np.uint8)
            word[:, :_WIDTH] = short
            words.append(word.view("<u8").ravel())
            counts.append(widen(rows["counts"][row].as_py()))
            ends.append([len(hist[-1]), len(words[-1])])
        codes, of_row = np.unique(np.concatenate(hist), return_inverse=True)
        at = np.repeat(of_row, np.concatenate(sizes))
        word = np.concatenate(words)
        del hist, sizes, words
        order = np.lexsort((word, at))
        a, w = at[order], word[order]
        del at, word
        fresh = np.r_[True, (a[1:] != a[:-1]) | (w[1:] != w[:-1])]
        pair = np.empty(len(order), np.int64)
        pair[order] = np.cumsum(fresh) - 1
        del order, w
        total = np.bincount(pair, np.concatenate(counts)).astype(np.int64)
        owner = a[fresh]
        stats = np.stack(
            [np.bincount(owner, total, minlength=len(codes))]
            + [
                np.bincount(owner, kind, minlength=len(codes))
                for kind in (total == 1, total == 2, total > 2)
            ],
            1,
        ).astype("<i8")
        out: dict[str, list] = {n: [] for n in schema.names}
        ends = np.cumsum(ends, axis=0)
        bucket = rows["bucket"][0].as_py()
        for row in range(rows.num_rows):
            (h0, p0), (h1, p1) = ends[row], ends[row + 1]
            out["bucket"].append(bucket)
            out["block"].append(rows["block"][row].as_py())
            out["kind"].append(0)
            out["stats"].append(narrow(stats[of_row[h0:h1]]))
            out["totals"].append(narrow(total[pair[p0:p1]]))
        many = np.isin(codes, heavy)
        own = np.concatenate(
            [
                [(total == r).sum() for r in (1, 2, 3, 4)],
                [stats[:, 0].sum(), ((stats[:, 0] > 0) & ~many & (codes != START)).sum()],
            ]
        ).astype("<i8")
        out["bucket"].append(bucket)
        out["block"].append(None)
        out["kind"].append(1)
        out["stats"].append(own.tobytes())
        out["totals"].append(
            np.concatenate([codes[many, None].astype("<u8").view("<i8"), stats[many]], 1).tobytes()
        )
        return pa.RecordBatch.from_pydict(out, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in in_order_runs(batches, "bucket"):
            bucket = table["bucket"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                yield solve(table.slice(a, b - a))

    return run


class Model:
    """What all blocks need besides their own arcs: a few numbers and the heavy histories."""

    def __init__(self, own: np.ndarray, heavy: np.ndarray, sums: dict[int, np.ndarray]) -> None:
        self.heavy = heavy
        self.heavy_stats = np.zeros((len(heavy), 4), np.int64)
        for i, code in enumerate(heavy.view(np.int64).tolist()):
            if code in sums:
                self.heavy_stats[i] = sums[code]
        known = int((self.heavy_stats[heavy != START, 0] > 0).sum())
        n1, n2, n3, n4, tokens, distinct = (int(x) for x in own)
        self.tokens = tokens
        #: The end is one of the distinct tokens.
        self.distinct = distinct + known + (tokens > 0)
        share = n1 / (n1 + 2 * n2) if n1 else 0.5
        steps = [(1, n1, n2), (2, n2, n3), (3, n3, n4)]
        self.discounts = np.array(
            [0.0]
            + [
                min(max(r - (r + 1) * share * more / n, 0.05), r - 0.05) if n and more else 0.5 * r
                for r, n, more in steps
            ]
        )


def _score(buckets: int, model: Model):
    def solve(payload: bytes, answers: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
        tokens = Tokens(payload, buckets, model.heavy)
        answers.sort()
        stats = np.concatenate([widen(a[1]) for a in answers]).reshape(-1, 4)
        totals = np.concatenate([widen(a[2]) for a in answers])
        state = np.zeros((len(tokens.hist), 4), np.int64)
        state[tokens.pair_hist[tokens.first]] = stats
        if len(model.heavy):
            at = np.minimum(np.searchsorted(tokens.hist, model.heavy), len(tokens.hist) - 1)
            here = tokens.hist[at] == model.heavy
            state[at[here]] = model.heavy_stats[here]
        count = state[tokens.word_at, 0]
        mass = model.tokens + ADD * (model.distinct + 1)
        root = (count + ADD) / mass
        seen = totals[tokens.pair]
        come = state[tokens.at]
        whole = np.maximum(come[:, 0], 1)
        off = model.discounts[np.minimum(seen, 3)]
        failure = (come[:, 1:] @ model.discounts[1:]) / whole
        arc = np.maximum(seen - off, 0) / whole + failure * root
        chance = np.where(come[:, 0] > 0, arc, root)
        edges = np.r_[0, np.cumsum(tokens.sizes)[:-1]]
        add = lambda values: np.add.reduceat(values, edges)
        n = len(tokens.sizes)
        return pa.RecordBatch.from_arrays(
            [
                tokens.ids.combine_chunks(),
                pa.array(tokens.held),
                pa.array(tokens.sizes),
                pa.array(add((count > 0).astype(np.int64))),
                pa.array(np.full(n, model.tokens, np.int64)),
                pa.array(add(np.log10(root))),
                pa.array(add(np.log10(chance))),
            ],
            names=["_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, answers = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("block")[row].as_py() != block:
                    block, answers = batch.column("block")[row].as_py(), []
                payload = batch.column("payload")[row].as_py()
                if payload is None:
                    answers.append(
                        tuple(batch.column(n)[row].as_py() for n in ("bucket", "stats", "totals"))
                    )
                else:
                    yield solve(payload, answers)

    return run


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    folds: int = 10,
    held_fold: int = 0,
) -> DataFrame:
    """Scores of all whole texts under a model of the texts not held out.

    A text is held out if crc32 of its id as text, modulo ``folds``, is
    ``held_fold`` (a null id: not held out).  Returns ``id_col, held_out,
    n_tokens, n_known, train_tokens, base_score, score``: logarithms to base 10
    of the root's probability alone and of the automaton's.  A-Z are lower-cased;
    a text's tokens are its words and one end, so null and empty texts have one
    token.  Repeated rows are learnt from and scored each.  Other columns don't
    matter.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    held = F.pmod(F.crc32(F.col("_id").cast("string").cast("binary")), F.lit(folds)) == held_fold
    rows = keyed(docs, id_col, text_col).select(
        F.col("_id").cast("long").alias("_id"),
        F.coalesce(held, F.lit(False)).alias("held"),
        F.coalesce("_text", F.lit(b"")).alias("_text"),
    )
    packs = stage(rows.mapInArrow(_packs(), "block long, payload binary"), "packs")
    held_bytes = packs.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), held_bytes // BUCKET_BYTES + 1)
    heavy = frequent_histories(rows)
    asked = packs.mapInArrow(_ask(buckets, heavy), _ASKED)
    totals = stage(
        asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "block")
        .mapInArrow(_totals(heavy), _TOTALS),
        "totals",
    )
    model = _model(totals.where("kind = 1"), heavy)
    none = lambda kind: F.lit(None).cast(kind)
    answers = totals.where("kind = 0").select(
        "block", "bucket", "stats", "totals", none("binary").alias("payload")
    )
    texts = packs.select(
        "block", F.lit(1 << 30).alias("bucket"), none("binary").alias("stats"),
        none("binary").alias("totals"), "payload",
    )
    met = answers.unionByName(texts).repartition(buckets, "block")
    scored = met.sortWithinPartitions("block", "bucket").mapInArrow(
        _score(buckets, model),
        "_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
    return scored.withColumnRenamed("_id", id_col)


def frequent_histories(rows: DataFrame) -> np.ndarray:
    """Hashes of the histories that a sample shows to be frequent, sorted; at most a thousand."""
    share = min(1.0, HEAVY_SAMPLE_ROWS / max(rows.count(), 1))
    words = rows.sample(share, seed=1).select(
        F.explode_outer(
            F.split(F.translate(F.decode("_text", "UTF-8"), _UPPER, _UPPER.lower()), r"[\x20\x09-\x0D]+")
        ).alias("w")
    ).where("w <> ''")
    counted = stage(words.groupBy("w").agg(F.count(F.lit(1)).alias("n")), "sampled")
    total = counted.agg(F.sum("n")).first()[0] or 0
    found = counted.where(F.col("n") >= max(total * HEAVY_SHARE, 20)).select("w").collect()
    return np.sort(np.append(hashes([row["w"].encode() for row in found]), START))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _model(rows: DataFrame, heavy: np.ndarray) -> Model:
    """Adds up the buckets' figures, bucket by bucket as they stream in."""
    own = np.zeros(6, np.int64)
    sums: dict[int, np.ndarray] = {}
    for row in rows.select("stats", "totals").toLocalIterator():
        own += np.frombuffer(row["stats"], "<i8")
        for line in np.frombuffer(row["totals"], "<i8").reshape(-1, 5):
            code = int(line[0])
            sums[code] = sums.get(code, 0) + line[1:]
    return Model(own, heavy, sums)
