"""Delimited extracts: audit, parse, and strict per-file quarantine.

Files are read as lines, so a large file is split over tasks.  One scan audits
every file (size, digest, where its header puts the required columns, whether
a quote stays open over a line end); the next parses the lines, each by the
layout of its file.  Files that hold records going over a line end are split
like all others; their lines are first put together by :mod:`.spans`.

A file is taken entirely or not at all.  Its first bad row is found from two
numbers per split, its row count and the place of its first bad row, so rows
are never numbered one by one.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tidemark.functions import rolling
from tidemark.functions.dates import flexible_date
from tidemark.functions.text import all_of, any_of, is_blank
from tidemark.operators.records import dedupe
from tidemark.schema import (
    IMPORT_SEPARATOR,
    KEY,
    RECORD_SCHEMA,
    REGISTRY_COLUMNS,
    REGISTRY_SEPARATOR,
)
from tidemark.session import small_frame, stage
from tidemark.sources import spans
from tidemark.sources.files import path_of

# Reason classes in order of precedence; the numbers are what is staged.
OK, SKIPPED, HEADER = 0, -1, -2
REASONS = ["arity", "encoding", "date", "id_1", "id_2", "vaccine_group", "oversized"]
MISSING_COLUMNS, TOO_MANY_COLUMNS = "missing_columns", "too_many_columns"

# Rejected files whose names may be broadcast; more are joined by shuffle.
BROADCAST_FILES = 100_000
# Files with records over line ends that are read again by name.
NAMED_FILES = 1_000

_REJECTS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("line_no", T.LongType()),
        T.StructField("reason", T.StringType()),
    ]
)
_REJECTS_ARROW = pa.schema(
    [("file", pa.string()), ("line_no", pa.int64()), ("reason", pa.string())]
)

_BITS = 15
_MISSING = (1 << _BITS) - 1
# Fields of a line that a parser makes room for.
_MOST_COLUMNS = 1 << 16
# The layout of a header with more columns than positions can be packed for.
_TOO_MANY = -1


@dataclass(frozen=True)
class Format:
    separator: str
    columns: list[str] = field(default_factory=list)

    @property
    def has_header(self) -> bool:
        return bool(self.columns)


REGISTRY = Format(REGISTRY_SEPARATOR, REGISTRY_COLUMNS)
IMPORT = Format(IMPORT_SEPARATOR)


@dataclass(frozen=True)
class Landing:
    """What one landing of files holds."""

    records: DataFrame  # rows of accepted files, with their file
    rejects: DataFrame  # file, line_no, reason: never a value
    files: DataFrame  # file, bytes, lines, content_hash, accepted


# --- audit -------------------------------------------------------------------


def _lines(text: DataFrame, keep_empty: bool = True) -> DataFrame:
    """Lines of text files with file, split and reading order."""
    lines = text if keep_empty else text.filter(F.col("value") != "")
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def _header_code(value: Column, fmt: Format) -> Column:
    """Positions of the required columns in a header line, packed in a number.

    A name that is absent packs as all ones; the last of equal names counts.
    """
    outside_quotes = "[" + fmt.separator + r'](?=(?:[^"]*"[^"]*")*[^"]*$)'
    clean = F.regexp_replace(value, "^\ufeff", "")
    # Looking ahead for quotes takes the square of a header's length.
    split = F.when(clean.contains('"'), F.split(clean, outside_quotes)).otherwise(
        F.split(clean, "[" + fmt.separator + "]")
    )
    names = F.transform(split, lambda name: F.regexp_replace(name, r'^"(.*)"$', "$1"))
    code = F.lit(0).cast("long")
    for name in fmt.columns:
        from_end = F.array_position(F.reverse(names), name)
        position = F.when(from_end == 0, F.lit(_MISSING)).otherwise(
            F.size(names) - from_end
        )
        code = code * (1 << _BITS) + position
    wide = F.size(names) >= _MISSING
    return F.when(wide, F.lit(_TOO_MANY).cast("long")).otherwise(code)


def _pack(positions: list[int]) -> int:
    code = 0
    for position in positions:
        code = (code << _BITS) + position
    return code


def _unpack(code: int | None, fmt: Format) -> list[int]:
    if code is None:
        return [_MISSING] * len(fmt.columns)
    count = len(fmt.columns)
    return [(code >> (_BITS * (count - 1 - i))) & _MISSING for i in range(count)]


def audit(text: DataFrame, fmt: Format) -> DataFrame:
    """One row per file, from one scan folded in a hash aggregate.

    Only numbers are kept per file: a line that names a required column packs
    its column positions, and the first line's packing is the file's layout.
    """
    lines = _lines(text)
    none_named = _pack([_MISSING] * len(fmt.columns))
    code = F.lit(0).cast("long")
    if fmt.has_header:
        names_one = any_of([F.col("value").contains(name) for name in fmt.columns])
        code = F.when(
            (F.col("block") == 0) & names_one, _header_code(F.col("value"), fmt)
        ).otherwise(F.lit(none_named).cast("long"))
    first = F.when(F.col("block") == 0, F.col("place"))
    splits = stage(
        lines.groupBy("file", "block").agg(
            F.max("bytes").alias("bytes"),
            F.count(F.lit(1)).alias("lines"),
            F.min_by(code, first).alias("layout"),
            F.max(spans.opens(F.col("value"), fmt.separator)).alias("spans_lines"),
            *[
                sums.alias(name)
                for name, sums in rolling.split_sums(F.col("value"), F.col("place")).items()
            ],
        ),
        "split-audit",
    )
    files = splits.groupBy("file").agg(
        F.max("bytes").alias("bytes"),
        F.sum("lines").alias("lines"),
        F.max("layout").alias("layout"),
        F.max("spans_lines").alias("spans_lines"),
    )
    return files.join(rolling.with_digest(splits, "file", "block", "content_hash"), "file")


def missing_columns(layout: int | None, fmt: Format) -> list[str]:
    """Required columns a header does not name, in their order."""
    return [
        name
        for name, position in zip(fmt.columns, _unpack(layout, fmt))
        if position == _MISSING
    ]


def _any_missing(layout: Column, fmt: Format) -> Column:
    parts = [F.shiftright(layout, _BITS * back) for back in range(len(fmt.columns))]
    missing = [part.bitwiseAND(F.lit(_MISSING)) == _MISSING for part in parts]
    return F.coalesce(any_of(missing), F.lit(True))


# --- parse -------------------------------------------------------------------


def _field_count(value: Column, separator: str) -> Column:
    """Fields on a line, separators inside quotes left out."""
    bare = F.regexp_replace(value, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1


def reason_code(
    raw: Column, ids: list[Column], day: Column, needed: Column, separator: str
) -> Column:
    """The first thing wrong with a row, as a number; OK if nothing is.

    ``ids`` are the two ids and the group, ``day`` the parsed date.
    """
    # A short line lacks its last fields, so only a row with a gap is counted.
    gap = any_of([one.isNull() for one in ids]) | day.isNull()
    short = gap & (_field_count(raw, separator) < needed)
    checks = [short, ~F.is_valid_utf8(raw), day.isNull(), *[is_blank(one) for one in ids]]
    oversized = F.lit(1 + REASONS.index("oversized"))
    code = F.when(raw == spans.OVERSIZED, oversized).when(checks[0], F.lit(1))
    for number, check in enumerate(checks[1:], start=2):
        code = code.when(check, F.lit(number))
    return code.otherwise(F.lit(OK))


def _csv_options(fmt: Format) -> dict[str, str]:
    return {
        "sep": fmt.separator, "quote": '"', "escape": '"', "maxColumns": str(_MOST_COLUMNS)
    }


def _split(value: Column, width: int, fmt: Format) -> Column:
    """The first ``width`` fields of a line; none of one with more than a parser takes."""
    fits = F.octet_length(value) < _MOST_COLUMNS
    columns = F.length(value) - F.length(F.replace(value, F.lit(fmt.separator), F.lit("")))
    fits = F.when(fits, F.lit(True)).otherwise(columns + 1 < _MOST_COLUMNS)
    return F.from_csv(F.when(fits, value), _schema(width), _csv_options(fmt))


def _parsed(
    rows: DataFrame,
    raw: Column,
    fields: list[Column],
    picked: list[Column],
    needed: Column,
    layout: Column,
    fmt: Format,
) -> DataFrame:
    """Typed record columns and a reason code for rows of split fields."""
    # The date is wanted twice; as a column of its own it is parsed once.
    rows = rows.select(
        "file",
        "block",
        "place",
        raw.alias("raw"),
        needed.alias("needed"),
        layout.alias("layout"),
        picked[0].alias("id_1"),
        picked[1].alias("id_2"),
        picked[2].alias("vaccine_group"),
        flexible_date(picked[3]).alias("vaccination_date"),
        all_of([is_blank(one) for one in fields]).alias("blank"),
    )
    raw, layout, ids = F.col("raw"), F.col("layout"), [F.col(name) for name in KEY[:3]]
    code = reason_code(raw, ids, F.col("vaccination_date"), F.col("needed"), fmt.separator)
    if fmt.has_header:
        names_all = all_of([raw.contains(name) for name in fmt.columns])
        header = names_all & (F.col("block") == 0) & (_header_code(raw, fmt) == layout)
        code = F.when(header, F.lit(HEADER)).otherwise(code)
    else:
        # A line without any text is passed over, whatever its separators.
        text = F.translate(raw, fmt.separator + '"', "")
        empty = F.col("blank") & is_blank(text)
        code = F.when(empty, F.lit(SKIPPED)).otherwise(code)
    return rows.select("file", "block", "place", *KEY, code.cast("tinyint").alias("code"))


def _schema(width: int) -> str:
    return ", ".join(f"c{i} string" for i in range(width))


def _parse_lines(lines: DataFrame, positions: list[int], fmt: Format) -> DataFrame:
    """Lines of files that all have one layout."""
    width = max(positions) + 1
    rows = lines.withColumn("c", _split(F.col("value"), width, fmt))
    fields = [F.col(f"c.c{i}") for i in range(width)]
    picked = [fields[position] for position in positions]
    layout = F.lit(_pack(positions)).cast("long")
    return _parsed(rows, F.col("value"), fields, picked, F.lit(width), layout, fmt)


def _parse_mixed(
    lines: DataFrame, layouts: DataFrame, few: bool, width: int, fmt: Format
) -> DataFrame:
    """Lines of files with several layouts, each looked up by file.

    Files that are not among ``layouts`` are left out.
    """
    rows = lines.join(F.broadcast(layouts) if few else layouts, "file")
    rows = rows.withColumn("c", _split(F.col("value"), width, fmt))
    fields = [F.col(f"c.c{i}") for i in range(width)]
    shifts = [_BITS * back for back in reversed(range(len(fmt.columns)))]
    positions = [
        F.shiftright("layout", shift).bitwiseAND(F.lit(_MISSING)).cast("int")
        for shift in shifts
    ]
    picked = [F.element_at(F.array(*fields), position + 1) for position in positions]
    needed = F.greatest(*positions) + 1
    return _parsed(rows, F.col("value"), fields, picked, needed, F.col("layout"), fmt)


# --- quarantine --------------------------------------------------------------


def first_bad_rows(parsed: DataFrame) -> DataFrame:
    """``file, line_no, reason`` of each file with a bad row.

    Line numbers count the rows a reader of that format would see, the header
    as 1.  Every split gives its first place, its row count and its first bad
    place; a running count over a file's splits does the rest.
    """
    bad = F.when(F.col("code") > 0, F.col("place"))
    header = F.when(F.col("code") == HEADER, F.col("place"))
    splits = parsed.groupBy("file", "block").agg(
        F.min("place").alias("start"),
        F.count(F.lit(1)).alias("rows"),
        F.min(bad).alias("bad"),
        F.min_by("code", bad).alias("code"),
        F.count(header).alias("headers"),
    )
    splits = stage(splits, "splits")
    # A header line met again further down is a data row with a bad date.
    if not splits.filter(F.col("headers") > 1).isEmpty():
        splits = _with_repeated_headers(parsed, splits)
    by_file = Window.partitionBy("file").orderBy("block")
    before = F.sum("rows").over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    line_no = F.coalesce(before, F.lit(0)) + F.col("bad") - F.col("start") + 1
    reason = F.element_at(F.lit(REASONS), F.col("code").cast("int"))
    return (
        splits.withColumn("line_no", line_no)
        .filter(F.col("bad").isNotNull())
        .groupBy("file")
        .agg(
            F.min("line_no").alias("line_no"),
            F.min_by(reason, "line_no").alias("reason"),
        )
    )


def _with_repeated_headers(parsed: DataFrame, splits: DataFrame) -> DataFrame:
    date = REASONS.index("date") + 1
    again = (
        parsed.filter(F.col("code") == HEADER)
        .join(splits.select("file", "block", "start"), ["file", "block"])
        .filter(F.col("place") > F.col("start"))
        .groupBy("file", "block")
        .agg(F.min("place").alias("again"))
    )
    earlier = F.col("again").isNotNull() & (
        F.col("bad").isNull() | (F.col("again") < F.col("bad"))
    )
    return (
        splits.join(again, ["file", "block"], "left")
        .withColumn("code", F.when(earlier, F.lit(date)).otherwise(F.col("code")))
        .withColumn("bad", F.when(earlier, F.col("again")).otherwise(F.col("bad")))
        .drop("again")
    )


def _rows(
    spark: SparkSession, text: DataFrame, audited: DataFrame, spanning: list[str], fmt: Format
) -> DataFrame:
    """A row per record: lines as they are, but for files with records over line ends.

    A reader of the header format never sees an empty line; one of the other
    format counts it.
    """
    columns = ["value", "file", "block", "place"]
    keep_empty = not fmt.has_header
    lines = _lines(text, keep_empty).select(*columns)
    if not spanning:
        return lines
    names = audited.filter("spans_lines").select("file")
    few = len(spanning) <= BROADCAST_FILES
    names = F.broadcast(names) if few else names
    if len(spanning) <= NAMED_FILES:
        parts = _lines(spark.read.text([path_of(file) for file in spanning]))
    else:
        parts = _lines(text).join(names, "file", "left_semi")
    whole = spans.records(parts, fmt.separator, keep_empty)
    return lines.join(names, "file", "left_anti").unionByName(whole)


def read_landing(
    spark: SparkSession, paths: list[str], fmt: Format, text: DataFrame | None = None
) -> Landing:
    """All files below ``paths``: accepted rows, rejected files, and an audit.

    The driver holds one row per file, as its own file listing already does;
    rows of files never pass through it.  ``text`` is a reader of the paths that
    has them listed already.
    """
    # One listing of the files serves both scans.
    text = spark.read.text(paths) if text is None else text
    audited = stage(audit(text, fmt), "audit")
    layouts: dict[tuple[int, ...], int] = defaultdict(int)
    spanning: list[str] = []
    refused: list[dict] = []
    for row in audited.select("file", "layout", "spans_lines").collect():
        positions = (0, 1, 2, 3)
        if fmt.has_header:
            if missing_columns(row["layout"], fmt):
                reason = TOO_MANY_COLUMNS if row["layout"] == _TOO_MANY else MISSING_COLUMNS
                refused.append({"file": row["file"], "line_no": 1, "reason": reason})
                continue
            positions = tuple(_unpack(row["layout"], fmt))
        layouts[positions] += 1
        if row["spans_lines"]:
            spanning.append(row["file"])
    rejects = small_frame(spark, refused, _REJECTS_ARROW, _REJECTS)
    if not layouts:
        nothing = F.lit(None)
        columns = [nothing.cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA]
        empty = spark.range(0).select(*columns, nothing.cast("string").alias("file"))
        return Landing(empty, rejects, audited.withColumn("accepted", F.lit(False)))
    lines = _rows(spark, text, audited, spanning, fmt)
    if len(layouts) == 1 and not refused:
        parsed = _parse_lines(lines, list(*layouts), fmt)
    else:
        width = max(map(max, layouts)) + 1
        few = sum(layouts.values()) <= BROADCAST_FILES
        usable = audited.select("file", "layout")
        if refused:
            usable = usable.filter(~_any_missing(F.col("layout"), fmt))
        parsed = _parse_mixed(lines, usable, few, width, fmt)
    parsed = stage(parsed, "parsed")
    rejects = stage(rejects.unionByName(first_bad_rows(parsed)), "rejects")
    good = parsed.filter(F.col("code") == OK).select(*KEY, "file")
    n_rejected = rejects.count()
    if n_rejected:
        names = rejects.select("file")
        names = F.broadcast(names) if n_rejected <= BROADCAST_FILES else names
        good = good.join(names, "file", "left_anti").select(*KEY, "file")
        files = audited.join(names.withColumn("accepted", F.lit(False)), "file", "left")
        files = files.withColumn("accepted", F.coalesce("accepted", F.lit(True)))
    else:
        files = audited.withColumn("accepted", F.lit(True))
    return Landing(good, rejects, files)


def combine(landing: Landing) -> DataFrame:
    """The distinct records of all accepted files."""
    return dedupe(landing.records)
