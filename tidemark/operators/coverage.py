"""Which sources answered: latest results, staged counts, missing sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def latest(entries: DataFrame, by: list[str], value: str, order: list[str]) -> DataFrame:
    """The value of each group's last entry.

    Folded on the map side, so a group holding most entries costs its tasks
    one row each.
    """
    return entries.groupBy(*by).agg(
        F.max_by(value, F.struct(*order)).alias(value), F.count(F.lit(1)).alias("entries")
    )


def with_latest(sources: DataFrame, listing: DataFrame, on: str, value: str) -> DataFrame:
    """Every source with its latest result; one without any is missing."""
    return sources.join(listing, on, "left").withColumn("staged", F.col(value).isNotNull())


def staged_counts(covered: DataFrame, by: list[str] | None = None) -> DataFrame:
    """How many sources have a result, and how many do not."""
    return covered.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("school_count"),
        F.count_if("staged").alias("staged"),
        F.count_if(~F.col("staged")).alias("missing"),
    )


def with_files(sources: DataFrame, files: DataFrame, path: Column) -> DataFrame:
    """Every source with its configured file, matched by path."""
    return sources.withColumn("_path", path).join(
        files.withColumnRenamed("path", "_path"), "_path", "left"
    ).drop("_path")


def not_submitted(expected: DataFrame, submitted: DataFrame, on: list[str]) -> DataFrame:
    """Expected sources without a submission."""
    return expected.join(submitted.select(*on).distinct(), on, "left_anti")
