"""Delimited files written from the tables and read back; names and sizes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import views
from tidemark.catalog.views import KEYS, LINE_SQL, RECORDS_SQL
from tidemark.functions import names, rolling
from tidemark.functions.dates import flexible_date, import_date
from tidemark.functions.digest import record_line
from tidemark.functions.text import is_blank
from tidemark.operators import numbering, records
from tidemark.schema import KEY
from tidemark.session import scratch_path, stage
from tidemark.sinks import export
from tidemark.sources import extracts, files
from tidemark.sources.extracts import IMPORT, REASONS, REGISTRY

# Events of all sources that one part of the landing files covers.
FILE_RECORDS = 20_000


# --- dates, blanks, arity ----------------------------------------------------


def _iso_week(day):
    thursday = F.date_add(day, 3 - F.weekday(day))
    return F.format_string(
        "%d-W%02d-%d", F.year(thursday), F.weekofyear(day), F.weekday(day) + 1
    )


def date_formats(spark, sf_dir):
    """Every accepted form of a date, and two that are refused."""
    rows = views.table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("date").alias("day"), "ts"
    )
    day = F.col("day")
    forms = [
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "M/d/yyyy"),
        F.date_format(day, "MM/dd/yyyy"),
        F.date_format(day, "yyyyMMdd"),
        F.concat(F.lit(" \t"), F.date_format(day, "yyyy-MM-dd"), F.lit(" ")),
        _iso_week(day),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        F.date_format(day, "yyyy-M-d"),
    ]
    text = F.element_at(F.array(*forms), (F.col("event_id") % 8 + 1).cast("int"))
    parsed = rows.withColumn("text", text).select(
        "event_id", flexible_date(F.col("text")).alias("parsed")
    )
    return parsed.withColumn("rendered", import_date(F.col("parsed")))


def blank_reject(spark, sf_dir):
    """Each record's blank fields; ids are made blank in several ways."""
    rows = views.records(spark, sf_dir)
    blanks = F.array(*[F.lit(text) for text in ["", "  ", " ", "\x1c", "　\t"]])
    blank = F.element_at(blanks, (F.col("event_id") % 5 + 1).cast("int"))
    hit = F.col("event_id") % 97 == 0
    rows = rows.withColumn("id_1", F.when(hit, blank).otherwise(F.col("id_1")))
    id_2_hit = F.col("event_id") % 101 == 0
    rows = rows.withColumn("id_2", F.when(id_2_hit, blank).otherwise(F.col("id_2")))
    first = F.when(is_blank(F.col("id_1")), F.lit("id_1")).when(
        is_blank(F.col("id_2")), F.lit("id_2")
    )
    return rows.select("event_id", F.coalesce(first, F.lit("")).alias("reason"))


def arity_reject(spark, sf_dir):
    """Lines with fewer or more fields than asked for."""
    whole = record_line()
    short = F.substring_index(whole, ",", 2)
    more = F.concat(whole, F.lit(",extra,columns"))
    lines = views.records(spark, sf_dir).select(
        "event_id",
        F.when(F.col("event_id") % 89 == 0, short)
        .when(F.col("event_id") % 83 == 0, more)
        .otherwise(whole)
        .alias("value"),
    )
    split = lines.withColumn(
        "c", F.from_csv("value", "c0 string, c1 string, c2 string, c3 string",
                        {"sep": ",", "quote": '"', "escape": '"'})
    )
    split = split.select(
        "event_id", "value", "c.c0", "c.c1", "c.c2", flexible_date(F.col("c.c3")).alias("day")
    )
    ids = [F.col("c0"), F.col("c1"), F.col("c2")]
    code = extracts.reason_code(F.col("value"), ids, F.col("day"), F.lit(4), ",")
    reason = F.when(code > 0, F.element_at(F.lit(REASONS), code))
    return split.select("event_id", F.coalesce(reason, F.lit("")).alias("reason"))


# --- landings ----------------------------------------------------------------


def _write_extracts(spark, sf_dir, rows, date=None, part_records=FILE_RECORDS):
    """Registry extracts: one file per source and part, two column orders."""
    path = scratch_path(spark, "extracts")
    rows = rows.select(
        "id_1",
        "id_2",
        F.lit("a|b \"c\"").alias("name"),
        F.col("vaccine_group").alias("vaccine_group_name"),
        (date if date is not None else F.col("vaccination_date").cast("string")).alias(
            "vaccination_date"
        ),
        F.substring("id_2", 2, 3).cast("int").alias("source"),
        F.floor(F.col("event_id") / F.lit(part_records)).alias("part"),
        "event_id",
    )
    orders = [
        ["id_1", "id_2", "name", "vaccine_group_name", "vaccination_date"],
        ["vaccination_date", "name", "vaccine_group_name", "id_2", "id_1"],
    ]
    for parity, columns in enumerate(orders):
        (
            rows.filter(F.col("source") % 2 == parity)
            .repartition("source", "part")
            .sortWithinPartitions("source", "part", "event_id")
            .select("source", "part", *columns)
            .write.mode("append")
            .partitionBy("source", "part")
            .option("header", "true")
            .option("sep", "|")
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "false")
            .option("ignoreTrailingWhiteSpace", "false")
            .csv(path)
        )
    return path


def _glob(path):
    return [f"{path}/*/*/part-*"]


def extract_roundtrip(spark, sf_dir):
    """Pipe files with two column orders, read back as the distinct records."""
    path = _write_extracts(spark, sf_dir, views.records(spark, sf_dir))
    return extracts.combine(extracts.read_landing(spark, _glob(path), REGISTRY))


def _spoilt(spark, sf_dir):
    """Extracts in which sources 2 and 5 have rows without a date."""
    rows = views.records(spark, sf_dir)
    bad = F.col("id_2").isin("S002", "S005") & (F.col("event_id") % 97 == 0)
    date = F.when(bad, F.lit("someday")).otherwise(F.col("vaccination_date").cast("string"))
    path = _write_extracts(spark, sf_dir, rows, date)
    return extracts.read_landing(spark, _glob(path), REGISTRY)


def _file_key(name):
    return F.regexp_extract("file", rf"/{name}=([0-9]+)/", 1).cast("int").alias(name)


def strict_file_reject(spark, sf_dir):
    """Rejected files with the line of their first bad row."""
    return _spoilt(spark, sf_dir).rejects.select(
        _file_key("source"), _file_key("part"), "line_no", "reason"
    )


def strict_file_survivors(spark, sf_dir):
    """The records of the files that were taken."""
    return extracts.combine(_spoilt(spark, sf_dir))


def landing_audit(spark, sf_dir):
    """Lines, bytes and line digest of every landing file."""
    return _spoilt(spark, sf_dir).files.select(
        _file_key("source"),
        _file_key("part"),
        "lines",
        "accepted",
    )


def _spanning(spark, sf_dir):
    """Extracts in which every fifth record goes on over line ends, one of them empty.

    In source 3 some such records have no date.
    """
    rows = views.records(spark, sf_dir)
    more = F.concat("vaccine_group", F.lit('\nsecond "line" | of\n\nthree'))
    group = F.when(F.col("event_id") % 5 == 0, more).otherwise(F.col("vaccine_group"))
    bad = (F.col("id_2") == "S003") & (F.col("event_id") % 95 == 0)
    date = F.when(bad, F.lit("some\nday")).otherwise(F.col("vaccination_date").cast("string"))
    path = _write_extracts(spark, sf_dir, rows.withColumn("vaccine_group", group), date)
    return extracts.read_landing(spark, _glob(path), REGISTRY)


def multiline_records(spark, sf_dir):
    """The distinct records of files whose records go on over line ends."""
    return extracts.combine(_spanning(spark, sf_dir))


def multiline_rejects(spark, sf_dir):
    """Rejected ones among such files: the first bad record, counted in records."""
    return _spanning(spark, sf_dir).rejects.select(
        _file_key("source"), _file_key("part"), "line_no", "reason"
    )


def import_roundtrip(spark, sf_dir):
    """The distinct records as one import file, read back."""
    path = scratch_path(spark, "import")
    distinct = stage(records.dedupe(views.records(spark, sf_dir)), "distinct")
    export.write_lines(distinct, path)
    return extracts.combine(extracts.read_landing(spark, [f"{path}/part-*"], IMPORT))


def blank_rows_skipped(spark, sf_dir):
    """Import files with rows of nothing but separators, quotes and spaces between their records."""
    path = scratch_path(spark, "blanks")
    rows = views.records(spark, sf_dir)
    blank = F.element_at(
        F.array(*[F.lit(text) for text in ["", ",,,", " , ,\t,", '"","",,', "  "]]),
        (F.col("event_id") % 5 + 1).cast("int"),
    )
    lines = F.when(F.col("event_id") % 7 == 0, F.array(blank, record_line())).otherwise(
        F.array(record_line())
    )
    rows.select(F.explode(lines).alias("value")).write.text(path, lineSep="\n")
    return extracts.combine(extracts.read_landing(spark, [f"{path}/part-*"], IMPORT))


def replaced_text_digest(spark, sf_dir):
    """Ordered digests of files with bytes that are no text, decoded with replacement."""
    path = scratch_path(spark, "broken")
    broken = F.concat(F.col("p_name"), F.unhex(F.lit("ff")).cast("string"), F.lit("x"),
                      F.unhex(F.lit("e282")).cast("string"))
    (
        views.table(spark, sf_dir, "part")
        .select((F.col("p_partkey") % 4).alias("part"), "p_partkey", broken.alias("value"))
        .repartition("part").sortWithinPartitions("part", "p_partkey")
        .select("part", "value").write.partitionBy("part").text(path, lineSep="\n")
    )
    return files.file_digests(spark, path).select(
        F.regexp_extract("path", r"/part=([0-9]+)/", 1).cast("int").alias("part"), "ordered_digest"
    )


def nway_union(spark, sf_dir):
    """Overlapping import files of every source combined in one dedupe."""
    path = scratch_path(spark, "nway")
    rows = views.records(spark, sf_dir)
    part = F.floor(F.col("event_id") / F.lit(FILE_RECORDS))
    (
        rows.withColumn("part", part)
        .repartition("id_2", "part")
        .sortWithinPartitions("id_2", "part", "event_id")
        .select("id_2", "part", record_line().alias("value"))
        .withColumnRenamed("id_2", "source")
        .write.partitionBy("source", "part")
        .text(path, lineSep="\n")
    )
    return extracts.combine(extracts.read_landing(spark, _glob(path), IMPORT))


def union_of_sources(spark, sf_dir):
    """Many overlapping sets into one with a single dedupe."""
    rows = views.records(spark, sf_dir)
    weeks = ["2024-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2024-01-29"]
    return records.union_all([views.since(rows, week) for week in weeks])


# --- exports, names, digests -------------------------------------------------


def _source_chunks(spark, sf_dir):
    distinct = stage(records.dedupe(views.records(spark, sf_dir)), "distinct")
    numbered = numbering.sequence(distinct, ["id_2"], KEY)
    chunk = (F.floor((F.col("seq") - 1) / F.lit(500)) + 1).cast("int")
    return numbered.withColumn("chunk", chunk)


def _chunk_files(spark, sf_dir):
    """Files of each source's lines, 500 to a file."""
    path = scratch_path(spark, "digest")
    (
        _source_chunks(spark, sf_dir)
        .withColumn("source", F.col("id_2"))
        .repartition("source", "chunk")
        .sortWithinPartitions("source", "chunk", "seq")
        .select("source", "chunk", record_line().alias("value"))
        .write.partitionBy("source", "chunk")
        .text(path, lineSep="\n")
    )
    return path


def _chunk_key():
    return [
        F.regexp_extract("path", r"/source=([^/]+)/", 1).alias("source"),
        F.regexp_extract("path", r"/chunk=([0-9]+)/", 1).cast("int").alias("chunk"),
    ]


def file_digest(spark, sf_dir):
    """SHA-256 and size of files of each source's lines, 500 to a file."""
    digests = files.file_sha256(spark, _chunk_files(spark, sf_dir))
    return digests.select(*_chunk_key(), "sha256", "length")


def ordered_digest(spark, sf_dir):
    """The digest of such files that knows the order of lines and no split."""
    digests = files.file_digests(spark, _chunk_files(spark, sf_dir))
    return digests.select(*_chunk_key(), "length", "ordered_digest")


def _rebaseline(spark, sf_dir):
    path = scratch_path(spark, "rebaseline")
    distinct = stage(records.dedupe(views.records(spark, sf_dir)), "distinct")
    export.write_chunks(distinct, path, views.AS_OF, 1000)
    return path


def folder_listing(spark, sf_dir):
    """Names of the files a chunked export put into a folder."""
    names_there = files.folder_names(spark, _rebaseline(spark, sf_dir))
    return names_there.select("file_name").distinct().orderBy("file_name")


def rebaseline_chunks(spark, sf_dir):
    """Lines and their order-free digest in each exported chunk file."""
    lines = spark.read.text(_rebaseline(spark, sf_dir))
    return lines.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("value").alias("first_line"),
        F.max("value").alias("last_line"),
    )


def landing_names(spark, sf_dir):
    """Landing and transformed names for sources named after parts."""
    stamp = F.lit("20240131_020900")
    unique = F.lower(F.lpad(F.hex("p_partkey"), 8, "0"))
    raw = names.landing_name(F.col("p_name"), stamp, unique)
    folder = F.concat(F.lit("/landing/"), raw)
    return views.table(spark, sf_dir, "part").select(
        "p_partkey",
        raw.alias("landing_name"),
        names.transformed_name(folder).alias("transformed_name"),
    )


QUERIES = {
    "date_formats": date_formats,
    "blank_reject": blank_reject,
    "arity_reject": arity_reject,
    "extract_roundtrip": extract_roundtrip,
    "strict_file_reject": strict_file_reject,
    "strict_file_survivors": strict_file_survivors,
    "landing_audit": landing_audit,
    "import_roundtrip": import_roundtrip,
    "multiline_records": multiline_records,
    "multiline_rejects": multiline_rejects,
    "nway_union": nway_union,
    "blank_rows_skipped": blank_rows_skipped,
    "replaced_text_digest": replaced_text_digest,
    "union_of_sources": union_of_sources,
    "file_digest": file_digest,
    "ordered_digest": ordered_digest,
    "folder_listing": folder_listing,
    "rebaseline_chunks": rebaseline_chunks,
    "landing_names": landing_names,
}

_DISTINCT = f"select distinct {KEYS} from ({RECORDS_SQL})"
_FILES = f"""
with rows as (
  select *, user_id % 8 as source, event_id // {FILE_RECORDS} as part,
         user_id % 8 in (2, 5) and event_id % 97 = 0 as bad,
         row_number() over (partition by user_id % 8, event_id // {FILE_RECORDS}
                            order by event_id) + 1 as line_no
  from (select e.user_id, r.* from ({RECORDS_SQL}) r join events e using (event_id))),
spoilt as (
  select source, part, min(line_no) as line_no from rows where bad group by source, part)"""
_CHUNKED = f"""
with numbered as (
  select {LINE_SQL} as line, (row_number() over (order by {KEYS}) - 1) // 1000 + 1 as chunk_no,
         (count(*) over () + 999) // 1000 as chunks
  from ({_DISTINCT})),
named as (
  select line, printf('2024-01-31_rebaseline_%02d-of-%02d.csv', chunk_no, chunks) as file_name
  from numbered)"""

_SPANNING = f"""
with rows as (
  select id_1, id_2, vaccination_date, event_id,
         case when event_id % 5 = 0
              then vaccine_group || chr(10) || 'second "line" | of' || chr(10) || chr(10) || 'three'
              else vaccine_group end as vaccine_group,
         user_id % 8 as source, event_id // {FILE_RECORDS} as part,
         user_id % 8 = 3 and event_id % 95 = 0 as bad,
         row_number() over (partition by user_id % 8, event_id // {FILE_RECORDS}
                            order by event_id) + 1 as line_no
  from (select e.user_id, r.* from ({RECORDS_SQL}) r join events e using (event_id))),
spoilt as (
  select source, part, min(line_no) as line_no from rows where bad group by source, part)"""
_CHUNK_LINES = f"""
with numbered as (
  select *, {LINE_SQL} as line, row_number() over (partition by id_2 order by {KEYS}) as seq,
         (row_number() over (partition by id_2 order by {KEYS}) - 1) // 500 + 1 as chunk
  from ({_DISTINCT}))"""
# Horner's rule from the last line to the first.
_ROLLED = [
    f"list_reduce(list(cast('0x' || substr(sha256(line), {1 + 7 * i}, 7) as hugeint) + 1 order by seq desc), "
    f"lambda a, x: (a * {base} + x) % {rolling.MODULUS})"
    for i, base in enumerate(rolling.BASES)
]

SQL = {
    "date_formats": """
select event_id, case when event_id % 8 < 6 then cast(ts as date) end as parsed,
       case when event_id % 8 < 6 then strftime(ts, '%m/%d/%Y') end as rendered
from events""",
    "blank_reject": """
select event_id, case when event_id % 97 = 0 then 'id_1' when event_id % 101 = 0 then 'id_2'
                      else '' end as reason from events""",
    "arity_reject": """
select event_id, case when event_id % 89 = 0 then 'arity' else '' end as reason from events""",
    "extract_roundtrip": _DISTINCT,
    "strict_file_reject": f"""{_FILES}
select cast(source as int) as source, cast(part as int) as part,
       cast(line_no as bigint) as line_no, 'date' as reason from spoilt""",
    "strict_file_survivors": f"""{_FILES}
select distinct {KEYS} from rows r where not exists (
  select 1 from spoilt s where s.source = r.source and s.part = r.part)""",
    "landing_audit": f"""{_FILES}
select cast(source as int) as source, cast(part as int) as part, count(*) + 1 as lines,
       not bool_or(bad) as accepted
from rows group by 1, 2""",
    "import_roundtrip": _DISTINCT,
    "nway_union": _DISTINCT,
    "blank_rows_skipped": _DISTINCT,
    "replaced_text_digest": f"""
with numbered as (
  select p_partkey % 4 as part, p_partkey as seq, p_name || chr(65533) || 'x' || chr(65533) as line from part)
select cast(part as int) as part,
       printf('%d-%08x%08x', count(*), {_ROLLED[0]}, {_ROLLED[1]}) as ordered_digest
from numbered group by part""",
    "union_of_sources": _DISTINCT,
    "multiline_records": f"""{_SPANNING}
select distinct {KEYS} from rows r where not exists (
  select 1 from spoilt s where s.source = r.source and s.part = r.part)""",
    "multiline_rejects": f"""{_SPANNING}
select cast(source as int) as source, cast(part as int) as part,
       cast(line_no as bigint) as line_no, 'date' as reason from spoilt""",
    "ordered_digest": f"""{_CHUNK_LINES}
select id_2 as source, cast(chunk as int) as chunk, sum(octet_length(encode(line)) + 1)::bigint as length,
       printf('%d-%08x%08x', count(*), {_ROLLED[0]}, {_ROLLED[1]}) as ordered_digest
from numbered group by id_2, chunk""",
    "file_digest": f"""{_CHUNK_LINES},
texts as (
  select id_2 as source, cast(chunk as int) as chunk,
         string_agg(line, chr(10) order by {KEYS}) || chr(10) as body
  from numbered group by id_2, chunk)
select source, chunk, sha256(body) as sha256, octet_length(encode(body)) as length from texts""",
    "folder_listing": f"{_CHUNKED} select distinct file_name from named",
    "rebaseline_chunks": f"""{_CHUNKED}
select file_name, count(*) as records, min(line) as first_line, max(line) as last_line
from named group by file_name""",
    "landing_names": """
select p_partkey,
       'vaccinations_' || replace(p_name, ' ', '_') || '_20240131_020900_'
         || lpad(lower(hex(p_partkey)), 8, '0') || '.csv' as landing_name,
       'transformed_vaccinations_' || replace(p_name, ' ', '_') || '_20240131_020900_'
         || lpad(lower(hex(p_partkey)), 8, '0') || '.csv' as transformed_name
from part""",
}
