"""Spelling variants: words one letter apart, found with bitsets over the vocabulary.

The vocabulary is dealt into blocks so that two words one inserted, deleted or
replaced letter apart meet in one.  Of such words the shorter has some ``m``
letters; the letters before and after the edit are equal, so the words share all
but a quarter of their letters in one of four ways: the front and the next
quarter, the front and the end, the next quarter and the back, or the back and
the quarter before it.  Which way, the length of the words' common front says,
so that each pair counts in one block alone.  Every word is in eight blocks.

Within a block (and several small ones taken together) an index holds for each
position and letter the set of words that have this letter there, as bits.  For
each word, letter by letter, sets are carried on of the words that agree so far,
and of those that agree but for one letter, one missing or one more; the latter
two look at positions shifted by one.  Each step is a few operations on words of
64 bits, for many words looked up at once.

A block over a bound is dealt out in slabs: each part of it as index against
each part of it as words looked up, every such pair a group of its own.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.frames import in_order_runs, join_rows
from tidemark.session import stage

#: Words shorter than this, or seen less often, are no words.
LEAST_LETTERS, LEAST_COUNT = 7, 2
#: A form is seen so many times as often as its variant.
RATIO = 10
#: Most words of a block in one group, and of small blocks that share an index.
BLOCK_WORDS, INDEX_WORDS = 4096, 1024
#: The same in letters, for long words.
BLOCK_LETTERS = 1 << 17
#: Words counted in a task before their counts are sent on.
HELD_WORDS = 200_000

#: Letters counted as parts of a word, once A to Z are lower case.
_LETTER = "[a-zÀ-ÿ]"
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _counted(least: int, every: int | None):
    """Counts of words; with ``every``, some runs lose a letter, as told by their hash."""
    runs = re.compile(_LETTER + "{%d,}" % least)

    def sent(totals: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())],
            names=["word", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                found = runs.findall((text.as_py() or b"").lower().decode("utf-8", "replace"))
                if not every:
                    totals.update(found)
                    continue
                begun = zlib.crc32(f"{doc_id.as_py() or ''}:".encode())
                for word, n in Counter(found).items():
                    h = zlib.crc32(word.encode(), begun)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    totals[word] += n
            if len(totals) > HELD_WORDS:
                yield sent(totals)
                totals = Counter()
        yield sent(totals)

    return run


def vocabulary(
    docs: DataFrame, id_col: str, text_col: str, least: int, least_count: int, every: int | None
) -> DataFrame:
    """``word, n``: the words of all texts that occur often enough."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")
    )
    counts = rows.mapInArrow(_counted(least, every), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _shared(m: Column) -> list[tuple[int, Column, Column]]:
    """For each way to share letters, how many at the front and at the end, if the shorter has ``m``."""
    front = F.floor(m / 2).cast("int")
    back = m - front
    more, less = F.floor(back / 2).cast("int"), F.floor(front / 2).cast("int")
    none = F.lit(0)
    return [(0, front + more, none), (1, front, back - more), (2, less, back), (3, none, m - less)]


def entries(words: DataFrame, least: int) -> DataFrame:
    """``word, n, m, way, block``: every word in each of its blocks."""
    size = F.length("word")
    places = [
        F.struct(
            m.cast("int").alias("m"),
            F.lit(way).alias("way"),
            F.concat_ws(
                "|",
                m.cast("string"),
                F.lit(str(way)),
                F.substring(F.col("word"), F.lit(1), at_front),
                F.substring(F.col("word"), size - at_end + 1, at_end),
            ).alias("block"),
        )
        for m in (size, size - 1)
        for way, at_front, at_end in _shared(m)
    ]
    each = words.select("word", "n", F.explode(F.array(*places)).alias("at"))
    return each.select("word", "n", "at.*").where(F.col("m") >= least)


def _most(m: Column) -> Column:
    """Words that a block of words of ``m`` letters may have in one group."""
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK_WORDS), F.floor(F.lit(BLOCK_LETTERS) / (m + 1)).cast("int")))


def grouped(each: DataFrame) -> DataFrame:
    """Entries with ``group``, and whether they are indexed and looked up there.

    Blocks of one word are left out: it has no neighbour there.
    """
    each = stage(each, "entries")
    sizes = each.groupBy("block", "m").agg(F.count(F.lit(1)).alias("_size"))
    parts = F.ceil(F.col("_size") / _most(F.col("m"))).cast("int")
    large = stage(
        sizes.where(F.col("_size") > _most(F.col("m"))).select("block", parts.alias("_parts")), "large"
    )
    yes, no = F.lit(True), F.lit(False)
    small = each.select("*", F.col("block").alias("group"), yes.alias("indexed"), yes.alias("sought"))
    if large.isEmpty():
        return small
    small = join_rows(small, large.select("block"), ["block"], "left_anti")
    dealt = join_rows(each, large, ["block"], "inner")
    own = F.pmod(F.xxhash64("word"), F.col("_parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("_parts") - 1)
    named = lambda i, j: F.concat_ws("|", "block", i.cast("string"), j.cast("string"))
    columns = ["word", "n", "m", "way", "block"]
    dealt = dealt.select(*columns, own.alias("_own"), F.explode(every).alias("_other"))
    indexed = dealt.select(*columns, named(F.col("_own"), F.col("_other")).alias("group"),
                           yes.alias("indexed"), no.alias("sought"))
    sought = dealt.select(*columns, named(F.col("_other"), F.col("_own")).alias("group"),
                          no.alias("indexed"), yes.alias("sought"))
    return small.select(indexed.columns).unionByName(indexed).unionByName(sought)


class Index:
    """Words of ``m`` and ``m + 1`` letters by position and letter, one bit a word."""

    def __init__(self, letters: np.ndarray, lengths: np.ndarray, n_letters: int, m: int) -> None:
        n = len(letters)
        self.m, self.width = m, max(1, -(-n // 64))
        self.at = np.zeros((m + 1, n_letters, self.width), np.uint64)
        self.of_length = np.zeros((2, self.width), np.uint64)
        places = np.arange(m + 1)
        for bit in range(min(64, n)):
            words = np.arange(bit, n, 64)
            # Words a multiple of 64 apart never share a cell.
            cells = (places[None, :], letters[words], (words // 64)[:, None])
            self.at[cells] |= np.uint64(1 << bit)
            self.of_length[lengths[words] - m, words // 64] |= np.uint64(1 << bit)

    def one_apart(self, sought: np.ndarray, longer: bool) -> np.ndarray:
        """For each row of letters the bits of the words one edit from it.

        Words sought have ``m`` letters, or ``m + 1`` if ``longer``; two words of
        ``m + 1`` letters are compared where both are the shorter.
        """
        equal = np.full((len(sought), self.width), _ALL)
        off = np.zeros_like(equal)  # a letter replaced, or (longer) one missing in the word
        extra = np.zeros_like(equal)  # the word has one more: its letters stand one place further on
        for i in range(self.m + longer):
            here = self.at[i, sought[:, i]]
            if longer:
                off = equal if i == 0 else off & self.at[i - 1, sought[:, i]] | equal
            else:
                extra = (extra | equal) & self.at[i + 1, sought[:, i]]
                off = off & here | equal & ~here
            equal = equal & here
        if longer:
            return off & self.of_length[0]
        return off & self.of_length[0] | (extra | equal) & self.of_length[1]


def _pairs(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit number of all bits that are set."""
    rows, words = np.nonzero(bits)
    single = np.unpackbits(bits[rows, words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    at, bit = np.nonzero(single)
    return rows[at], words[at] * 64 + bit


def neighbours(words: list[str], n: np.ndarray, way: np.ndarray, group: np.ndarray,
               indexed: np.ndarray, sought: np.ndarray, m: int):
    """Entries with a near word, the number of these, and the most frequent one's entry."""
    letters = np.array(words, f"U{m + 1}").view(np.uint32).reshape(len(words), m + 1)
    lengths = (letters > 0).sum(1)
    alphabet, coded = np.unique(letters, return_inverse=True)
    coded = coded.reshape(letters.shape)
    held = np.flatnonzero(indexed)
    index = Index(coded[held], lengths[held], len(alphabet), m)
    ones, others = [], []
    for longer in (False, True):
        asked = np.flatnonzero(sought & (lengths == m + longer))
        if len(asked):
            row, bit = _pairs(index.one_apart(coded[asked], longer))
            ones.append(asked[row])
            others.append(held[bit])
    one, other = np.concatenate(ones), np.concatenate(others)
    met = group[one] == group[other]
    one, other = one[met], other[met]
    # The length of the common front tells the one way in which a pair counts.
    common = (letters[one] != letters[other]).argmax(1)
    front = m // 2
    borders = np.array([front + (m - front) // 2, front, front // 2])
    counts = (common[:, None] < borders[None, :]).sum(1) == way[one]
    one, other = one[counts], other[counts]
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(np.array(words), kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], one))
    one, other = one[order], other[order]
    found, first, near = np.unique(one, return_index=True, return_counts=True)
    return found, near, other[first]


def _units(group: np.ndarray, most: int) -> Iterator[slice]:
    """Whole runs of equal groups, as many as ``most`` entries allow, one at least."""
    starts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    at = 0
    while at < len(group):
        upto = max(np.searchsorted(starts, at + most, "right") - 1, np.searchsorted(starts, at, "right"))
        yield slice(at, int(starts[upto]))
        at = int(starts[upto])


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in in_order_runs(batches, "group"):
        group = np.asarray(table.column("group").combine_chunks().dictionary_encode().indices)
        table = table.filter(pa.array(np.bincount(group)[group] > 1))
        if not table.num_rows:
            continue
        group = np.asarray(table.column("group").combine_chunks().dictionary_encode().indices)
        m = table.column("m").to_numpy()
        borders = np.append(np.flatnonzero(np.diff(m, prepend=-1)), len(m))
        for begin, end in zip(borders[:-1], borders[1:]):
            letters = int(m[begin])
            most = max(1, min(INDEX_WORDS, BLOCK_LETTERS // (letters + 1)))
            for unit in _units(group[begin:end], most):
                part = table.slice(begin + unit.start, unit.stop - unit.start)
                words = part.column("word").to_pylist()
                n = part.column("n").to_numpy()
                found, near, form = neighbours(
                    words, n, part.column("way").to_numpy(), group[begin:end][unit],
                    part.column("indexed").to_numpy(zero_copy_only=False),
                    part.column("sought").to_numpy(zero_copy_only=False), letters,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([words[i] for i in found], pa.string()),
                        pa.array(near, pa.int64()),
                        pa.array(n[form], pa.int64()),
                        pa.array([words[i] for i in form], pa.string()),
                    ],
                    names=["word", "near", "form_n", "form"],
                )


def roots(links: DataFrame, most: int) -> DataFrame:
    """``word, root``: the last form that the forms of each linked word lead to.

    Each form is seen :data:`RATIO` times as often, so ``most`` occurrences bound
    the links in a row; every round doubles the links gone.
    """
    jumps = links.select("word", F.col("form").alias("root"))
    steps = max(1, math.floor(math.log(max(most / LEAST_COUNT, 1), RATIO) + 1e-9))
    for _ in range(math.ceil(math.log2(steps))):
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        jumps = stage(
            jumps.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "jumps"
        )
    return jumps


def variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST_LETTERS,
    drop_one_in: int | None = None,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the texts.

    Words are runs of Latin letters, only A to Z made lower case, of at least
    ``least`` letters and two occurrences.  Near words differ by one inserted,
    deleted or replaced letter.  The form is the near word of most occurrences
    (of ties the first in code-point order) if it has ten times the word's; the
    root is where forms lead to in the end, the word itself without a form.

    With ``drop_one_in``, a run loses one letter if that number divides the crc32
    of its document's id and the run: noise to find again.  A null id counts as
    an empty one.  Null and empty texts have no words; repeated rows count each;
    other columns don't matter; an empty table gives an empty result.
    """
    words = stage(vocabulary(docs, id_col, text_col, least, LEAST_COUNT, drop_one_in), "words")
    groups = grouped(entries(words, least)).select("word", "n", "m", "way", "group", "indexed", "sought")
    # Ways in numpy are 0 to 3 by how many borders the common front stays below.
    found = (
        groups.repartition("group").sortWithinPartitions("m", "group")
        .mapInArrow(_near, "word string, near long, form_n long, form string")
        .groupBy("word")
        .agg(
            F.sum("near").alias("n_near"),
            F.min(F.struct((-F.col("form_n")).alias("back"), "form")).alias("best"),
        )
    )
    joined = stage(
        words.join(found, "word", "left")
        .withColumn("_n", -F.col("best.back"))
        .withColumn("_is", F.col("_n") >= RATIO * F.col("n"))
        .select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("_is"), F.col("best.form")).alias("form"),
            F.when(F.col("_is"), F.col("_n")).alias("form_n"),
        ),
        "forms",
    )
    most = words.agg(F.max("n")).first()[0] or 0
    ends = roots(joined.where("form is not null"), most)
    return joined.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
