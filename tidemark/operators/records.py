"""The record algebra: dedupe, union, diff, membership.

Diffs come in three shapes with equal results.  Which one runs is decided by
the measured size of the batch, never by a guess:

* a batch that fits a broadcast probes the master where it lies;
* a larger one is shuffled to the master's buckets and hashed there, so the
  master is streamed without being shuffled or sorted;
* beyond that a plain anti-join lets Spark sort and spill.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tidemark.schema import KEY

# Bytes of key text a broadcast batch may hold, counted before it is sent.
BROADCAST_BYTES = 64 * 1024 * 1024
# Bytes of key text one task may hold as the hashed side of a join.
TASK_HASH_BYTES = 256 * 1024 * 1024
# What a hashed row costs beside its text.
ROW_OVERHEAD = 96


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, limit: int) -> bool:
        return self.bytes <= limit


def measure(records: DataFrame, by: list[str] | None = None) -> Size:
    """Row count and in-memory bytes of a record set, in one aggregate.

    ``by`` are text columns that belong to the key besides.
    """
    text = sum((F.octet_length(name) for name in [*(by or []), *KEY[:3]]), F.lit(ROW_OVERHEAD))
    row = records.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(text.cast("long")), F.lit(0)).alias("bytes"),
    ).first()
    return Size(row["rows"], row["bytes"])


def dedupe(records: DataFrame) -> DataFrame:
    """One row per record.  Copies fold on the map side, before the shuffle."""
    return records.select(*KEY).dropDuplicates(KEY)


def first_seen(records: DataFrame, order: str) -> DataFrame:
    """One row per record with the position of its first occurrence."""
    return records.groupBy(*KEY).agg(F.min(order).alias("first_seen"))


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    return dedupe(left.select(*KEY).unionByName(right.select(*KEY)))


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Many sets into one with a single dedupe, however many parts."""
    whole = parts[0].select(*KEY)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*KEY))
    return dedupe(whole)


def advance(known: DataFrame, new: DataFrame) -> DataFrame:
    """The next master.  ``new`` is disjoint from ``known``, so nothing is
    shuffled to find out."""
    return known.select(*KEY).unionByName(new.select(*KEY))


def diff(current: DataFrame, known: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Rows of ``current`` that are not in ``known``; keeps left duplicates."""
    return current.join(known.select(*key), key, "left_anti")


def hits(current: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``current`` that are in ``known``."""
    return current.join(known.select(*KEY), KEY, "left_semi")


def diff_broadcast(current: DataFrame, known: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Diff for a deduplicated batch small enough to broadcast."""
    probe = F.broadcast(current.select(*key))
    seen = known.select(*key).join(probe, key, "left_semi").dropDuplicates(key)
    # ``seen`` is a subset of ``current``, so the same bound covers it.
    return current.join(F.broadcast(seen), key, "left_anti")


def diff_hashed(current: DataFrame, known: DataFrame) -> DataFrame:
    """Diff for a batch whose share of each bucket fits one task.

    The batch is the hashed side; a bucketed master keeps its place and order.
    """
    probe = current.select(*KEY).hint("shuffle_hash")
    seen = known.select(*KEY).join(probe, KEY, "left_semi")
    return current.join(seen, KEY, "left_anti")


def new_records(
    current: DataFrame, known: DataFrame, size: Size, partitions: int
) -> DataFrame:
    """The diff in the shape the measured batch size allows.

    ``current`` is deduplicated and staged: it is read more than once.
    """
    if size.fits(BROADCAST_BYTES):
        return diff_broadcast(current, known)
    if size.fits(TASK_HASH_BYTES * partitions // 4):
        return diff_hashed(current, known)
    return diff(current, known)


def counts(current: DataFrame, known: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """New, total and known rows per group, and the size of the next master.

    Each set is folded to one row per group on the map side; only those rows
    are shuffled.
    """
    tagged = (
        current.select(*by, F.lit(0).alias("_set"))
        .unionByName(known.select(*by, F.lit(1).alias("_set")))
        .unionByName(new.select(*by, F.lit(2).alias("_set")))
    )
    return tagged.groupBy(*by).agg(
        F.count_if(F.col("_set") == 2).alias("new_count"),
        F.count_if(F.col("_set") == 0).alias("total_count"),
        F.count_if(F.col("_set") == 1).alias("known_count"),
        F.count_if(F.col("_set") >= 1).alias("record_count"),
    )
