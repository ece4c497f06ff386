"""Row numbers over a total order, without one task seeing everything.

Rows are range partitioned and sorted once and written with their place in
that order.  A partition's rows are then numbered by adding how many rows lie
in the partitions before it, which is one number per partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.schema import CHUNK_RECORDS
from tidemark.session import small_frame, stage

# Rows a single group may hold before its numbering is spread over tasks.
HOT_ROWS = 5_000_000
# Hot groups that may be broadcast by name.
HOT_GROUPS = 1_000_000

_POSITION_BITS = 33

_OFFSETS = T.StructType(
    [T.StructField("_part", T.LongType()), T.StructField("_before", T.LongType())]
)
_OFFSETS_ARROW = pa.schema([("_part", pa.int64()), ("_before", pa.int64())])


@dataclass(frozen=True)
class Numbered:
    rows: DataFrame
    total: int


def number_rows(df: DataFrame, order: list[str]) -> Numbered:
    """``row_index`` from 0 over ``order``, which must tell all rows apart."""
    spark = df.sparkSession
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = stage(placed, "ordered")
    part = F.shiftright("_place", _POSITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    # One row per shuffle partition.
    sizes = sorted((row["_part"], row["n"]) for row in sizes.collect())
    ends = list(accumulate(n for _, n in sizes))
    total = ends[-1] if ends else 0
    before = [
        {"_part": place, "_before": end - n} for (place, n), end in zip(sizes, ends)
    ]
    offsets = small_frame(spark, before, _OFFSETS_ARROW, _OFFSETS)
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    rows = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("row_index", F.col("_before") + position)
        .drop("_place", "_before")
    )
    return Numbered(rows, total)


def chunks(df: DataFrame, order: list[str], size: int = CHUNK_RECORDS) -> Numbered:
    """``chunk_no`` from 1: full chunks of ``size`` rows, the last one short."""
    if size < 1:
        raise ValueError("a chunk holds at least one record")
    numbered = number_rows(df, order)
    chunk = (F.floor(F.col("row_index") / F.lit(size)) + 1).cast("long")
    return Numbered(numbered.rows.drop("_part").withColumn("chunk_no", chunk), numbered.total)


def sequence(
    df: DataFrame,
    group: list[str],
    order: list[str],
    name: str = "seq",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``name`` from 1 inside each group, in ``order``.

    Groups are counted first, with the counts folded before the shuffle.  Those
    of ordinary size take a window; larger ones are spread by range.
    """
    hot = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot.filter(F.col("_n") > hot_rows).select(*group)
    n_hot = hot.count()
    window = Window.partitionBy(*group).orderBy(*order)
    if n_hot == 0:
        return df.withColumn(name, F.row_number().over(window).cast("long"))
    hot = stage(hot, "hot")
    names = F.broadcast(hot) if n_hot <= HOT_GROUPS else hot
    cold = df.join(names, group, "left_anti").withColumn(
        name, F.row_number().over(window).cast("long")
    )
    spread = _spread_sequence(df.join(names, group, "left_semi"), group, order, name)
    return cold.unionByName(spread.select(*cold.columns))


def _spread_sequence(
    df: DataFrame, group: list[str], order: list[str], name: str
) -> DataFrame:
    numbered = number_rows(df, group + order).rows
    starts = numbered.groupBy("_part", *group).agg(F.min("row_index").alias("_start"))
    # Every group a partition begins with may have begun in an earlier one; all
    # others begin inside it.  A group's slices are at most one per partition.
    first = F.min("_start").over(Window.partitionBy(*group))
    carried = starts.withColumn("_first", first).filter(F.col("_first") < F.col("_start"))
    slices = Window.partitionBy("_part", *group)
    return (
        numbered.withColumn("_start", F.min("row_index").over(slices))
        .join(F.broadcast(carried.drop("_start")), ["_part", *group], "left")
        .withColumn(
            name,
            F.col("row_index") - F.coalesce(F.col("_first"), F.col("_start")) + 1,
        )
    )


def segments(
    df: DataFrame,
    group: list[str],
    order: list[str],
    item: Column,
    per_segment: int = 100,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Each group's items in order, as consecutive lists of bounded length."""
    numbered = sequence(df, group, order, "seq", hot_rows)
    return (
        numbered.withColumn("segment", F.floor((F.col("seq") - 1) / F.lit(per_segment)) + 1)
        .groupBy(*group, "segment")
        .agg(F.sort_array(F.collect_list(F.struct("seq", item.alias("item")))).alias("_items"))
        .withColumn("items", F.col("_items.item"))
        .drop("_items")
    )
