"""Content digests.

A set's fingerprint is a sum of per-line digests.  Sums merge, so it needs no
order, no single task and no second look at rows already counted: the
fingerprint of a union of disjoint sets is the sum of theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import import_date
from tidemark.functions.text import line
from tidemark.schema import IMPORT_SEPARATOR


def record_line(separator: str = IMPORT_SEPARATOR) -> Column:
    """A record as the import file writes it."""
    return line(
        [
            F.col("id_1"),
            F.col("id_2"),
            F.col("vaccine_group"),
            import_date(F.col("vaccination_date")),
        ],
        separator,
    )


def line_digest(text: Column) -> Column:
    """The first 60 bits of the line's SHA-256 as a number."""
    head = F.substring(F.sha2(text, 256), 1, 15)
    return F.conv(head, 16, 10).cast("decimal(38,0)")


def digest_sum(text: Column) -> Column:
    """The order-free digest of a group of lines, as an aggregate."""
    return F.coalesce(F.sum(line_digest(text)), F.lit(0).cast("decimal(38,0)"))


def fingerprint(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Row count and digest sum of a record set, whole or per group."""
    return records.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("records"),
        digest_sum(record_line()).alias("fingerprint"),
    )
