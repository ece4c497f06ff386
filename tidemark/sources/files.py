"""Files as they lie in storage: names, sizes, digests."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import rolling
from tidemark.functions.digest import digest_sum
from tidemark.session import stage

# The largest file of which one task makes a SHA-256.
WHOLE_FILE_BYTES = 512 * 1024 * 1024


def literal_path(path: str) -> str:
    """A path pattern that matches this one name, whatever characters it has."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def path_of(file: str) -> str:
    """The pattern of a file named as the scan names it, which is URI encoded."""
    return literal_path(unquote(file))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and name; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            "path", "length", F.substring_index("path", "/", -1).alias("file_name")
        )
    )


def count_files(spark: SparkSession, paths: list[str], text: DataFrame | None = None) -> int:
    """How many files lie there, those without a byte too, which no scan gives.

    ``text`` is a reader of the paths that has them listed already.
    """
    return len((spark.read.text(paths) if text is None else text).inputFiles())


def folder_names(spark: SparkSession, path: str) -> DataFrame:
    """Name and content of the exported files present in a delivery folder.

    An exported file is a folder named after it, its parts lie inside, and the
    folder above names the content.  A folder that is not there is an empty one.
    """
    try:
        listed = list_files(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = spark.range(0).select(F.lit("").alias("path"))
    found = r"/(?:fp=)?([^/]+)/file_name=([^/]+)/[^/]+$"
    return (
        listed.select(
            F.regexp_extract("path", found, 2).alias("file_name"),
            F.regexp_extract("path", found, 1).alias("remote_id"),
        )
        .filter(F.col("file_name") != "")
        .distinct()
    )


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Size, order-free line digest and ordered digest of every file below a folder.

    Files of all sizes are read as lines by many tasks; text that is not UTF-8
    counts as decoded with replacement, any line end as one line feed.  Spark's
    readers pass over files without a byte.
    """
    # The scan gives URI-encoded names, in which a plus sign is a plus sign.
    name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .text(path)
        .select(
            "value",
            name.alias("_name"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        )
    )
    sums = rolling.split_sums(F.col("value"), F.col("_place"))
    splits = stage(
        lines.groupBy("_name", "_block").agg(
            digest_sum(F.make_valid_utf8("value")).alias("_free"),
            *[column.alias(key) for key, column in sums.items()],
        ),
        "split-digests",
    )
    free = splits.groupBy("_name").agg(F.sum("_free").cast("string").alias("line_digest"))
    ordered = rolling.with_digest(splits, "_name", "_block", "ordered_digest")
    found = free.join(ordered, "_name").select(_plain("_name"), "line_digest", "ordered_digest")
    listed = list_files(spark, path).select("path", "length", _plain("path"))
    none = rolling.written(F.lit(0), F.lit(0), F.lit(0))
    return listed.join(found, "_plain", "left").select(
        "path",
        "length",
        F.coalesce("line_digest", F.lit("0")).alias("line_digest"),
        F.coalesce("ordered_digest", none).alias("ordered_digest"),
    )


def _plain(name: str):
    """A file's name without its scheme, as the two scans write it differently."""
    return F.regexp_replace(name, r"^[a-z0-9]+:/+", "/").alias("_plain")


def file_sha256(spark: SparkSession, path: str) -> DataFrame:
    """Size and SHA-256 of every file below a folder, for callers that need the bytes' own.

    A task holds a whole file, so a file over ``WHOLE_FILE_BYTES`` fails the job.
    """
    digest = F.when(F.col("length") <= WHOLE_FILE_BYTES, F.sha2("content", 256)).otherwise(
        F.raise_error(F.concat(F.lit("too large for one task: "), F.col("path")))
    )
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", digest.alias("sha256"))
    )
