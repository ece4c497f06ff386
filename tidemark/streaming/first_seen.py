"""First occurrence of every record of an endless stream.

There is no watermark, because age never makes a record new again; so state
grows with the number of distinct records.  The landing diff, whose state is
the master table, is the form for large sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.schema import KEY

# Tasks the copies of one record are spread over before they meet.
SPREAD = 16


def first_seen_stream(records: DataFrame, spread_by: str, spread: int = SPREAD) -> DataFrame:
    """Each record once.

    Copies fold in two steps: first among those that share a slice of
    ``spread_by``, so a record that fills the stream keeps many tasks busy,
    then over the at most ``spread`` that are left.
    """
    slices = F.pmod(F.xxhash64(spread_by), F.lit(spread))
    return (
        records.withColumn("_slice", slices)
        .select(*KEY, "_slice")
        .dropDuplicates([*KEY, "_slice"])
        .select(*KEY)
        .dropDuplicates(KEY)
    )
