"""Import files: bounded, quoted as needed, written by many tasks.

Spark names the files it writes, so an exported file is a folder that bears
the file's name.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.digest import record_line
from tidemark.functions.names import chunk_name, diff_name
from tidemark.operators.numbering import Numbered, chunks
from tidemark.schema import CHUNK_RECORDS, KEY

logger = logging.getLogger(__name__)


def render(records: DataFrame) -> DataFrame:
    """Records as import-file lines."""
    return records.select(record_line().alias("value"))


def write_lines(records: DataFrame, path: str) -> None:
    """One import file in record order; large sets take several parts."""
    ordered = records.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    render(ordered).write.mode("overwrite").text(path, lineSep="\n")


def diff_path(root: str, as_of: dt.date, segment: str) -> str:
    return f"{root}/date={as_of.isoformat()}/fp={segment}/file_name={diff_name(as_of)}"


def write_diff(records: DataFrame, root: str, as_of: dt.date, segment: str) -> str:
    """The dated diff, in a folder named by its content: a rerun of the same
    diff writes the same place."""
    path = diff_path(root, as_of, segment)
    write_lines(records, path)
    return path


def archive(records: DataFrame, root: str, as_of: dt.date, segment: str) -> bool:
    """A copy kept even if the gate stops the diff.  Best effort."""
    try:
        path = f"{root}/date={as_of.isoformat()}/fp={segment}"
        records.select(*KEY).write.mode("ignore").parquet(path)
    except Exception as error:  # noqa: BLE001
        logger.warning("archive failed: %s", type(error).__name__)
        return False
    return True


def write_chunks(
    records: DataFrame, root: str, as_of: dt.date, size: int = CHUNK_RECORDS
) -> Numbered:
    """The whole set in numbered files of at most ``size`` rows.

    Rows of one chunk meet in one task, at most ``size`` of them, and are
    written in record order.
    """
    numbered = chunks(records.select(*KEY), KEY, size)
    total = -(-numbered.total // size)
    if not total:
        return numbered
    name = chunk_name(F.lit(as_of.isoformat()), F.col("chunk_no"), F.lit(total))
    named = numbered.rows.withColumn("file_name", name)
    (
        named.repartition("file_name")
        .sortWithinPartitions("file_name", "row_index")
        .select("file_name", record_line().alias("value"))
        .write.mode("overwrite")
        .partitionBy("file_name")
        .text(root, lineSep="\n")
    )
    return numbered
