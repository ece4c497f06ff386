"""Ledger analytics, claims, deliveries, reconciliation, source coverage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import views
from tidemark.catalog.views import ACKS_SQL, DIGEST_SQL, RUNS_SQL
from tidemark.functions.dates import month_window, period
from tidemark.functions.digest import fingerprint
from tidemark.functions.events import detail, event, payload
from tidemark.functions.names import event_name
from tidemark.operators import coverage, numbering, reconcile, runs
from tidemark.schema import EVENT_FIELDS, TERMINAL_TYPES
from tidemark.session import scratch_path
from tidemark.sources import dimension, files, ledger, months

LISTED_SINCE = dt.date(2001, 7, 25)
PERIOD = "2001-07"


# --- runs --------------------------------------------------------------------


def run_sequence(spark, sf_dir):
    return views.run_events(spark, sf_dir).select(
        "event_id", "run_id", "seq", event_name(F.col("seq"), F.col("type")).alias("name")
    )


def run_timeline(spark, sf_dir):
    """A run's events in order, in lists of at most 100."""
    rows = views.table(spark, sf_dir, "events").select(
        F.col("user_id"), F.col("ts").alias("at"), "event_id", "event_type"
    )
    listed = numbering.segments(
        rows, ["user_id"], ["at", "event_id"], F.col("event_type"), per_segment=100
    )
    return listed.select(
        "user_id", "segment", F.array_join("items", ">").alias("timeline")
    )


def run_summary(spark, sf_dir):
    return runs.summarize(views.run_events(spark, sf_dir), ["run_id"], views.RUN_TERMINAL)


def recent_runs(spark, sf_dir):
    summary = runs.summarize(views.run_events(spark, sf_dir), ["run_id"], views.RUN_TERMINAL)
    return runs.newest(summary, ["run_id"], 10)


def recent_run_events(spark, sf_dir):
    """Everything the ten newest runs wrote."""
    return runs.of_newest_runs(views.run_events(spark, sf_dir), 10).select(
        "run_id", "seq", "type"
    )


RECENT = 40
#: Days that one run's events spread over, so that runs go on over ends of months.
RUN_DAYS = 3
FOLDED_ON = dt.date(2001, 7, 20)


def _folded_ledger(spark, sf_dir):
    """Orders as events of runs of some days, filed by month and folded but for the last months."""
    day = F.datediff("o_orderdate", F.lit("1970-01-01"))
    rows = views.table(spark, sf_dir, "orders").select(
        F.format_string("run_%05d", F.floor(day / RUN_DAYS)).alias("run_id"),
        F.concat(F.lit("Order"), "o_orderstatus").alias("type"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("at"),
        F.create_map(F.lit("order"), F.col("o_orderkey").cast("string")).alias("data"),
        "o_orderkey",
    )
    path = f"{scratch_path(spark, 'ledger')}/ledger"
    ledger.append(numbering.sequence(rows, ["run_id"], ["at", "o_orderkey"]), path)
    months.fold(spark, path, FOLDED_ON)
    return path


def recent_by_month(spark, sf_dir):
    """Events of the newest runs, read from the months they lie in."""
    return months.recent(spark, _folded_ledger(spark, sf_dir), RECENT).select(
        "run_id", "seq", "type", F.col("data")["order"].cast("long").alias("order_key")
    )


def folded_months(spark, sf_dir):
    """The folded ledger read as a whole, by month."""
    events = months.read(spark, _folded_ledger(spark, sf_dir))
    return events.groupBy(F.year("at").alias("year"), F.month("at").alias("month"), "type").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("seq") == 1).alias("started"),
        F.sum(F.col("data")["order"].cast("long")).alias("order_keys"),
    )


def claim_winner(spark, sf_dir):
    attempts = views.table(spark, sf_dir, "events").select(
        "event_type",
        F.col("ts").cast("date").alias("day"),
        F.col("user_id").alias("run_id"),
        F.col("ts").alias("at"),
    )
    return runs.claim_winners(attempts, ["event_type", "day"])


def run_totals(spark, sf_dir):
    rows = views.records(spark, sf_dir)
    return rows.groupBy("vaccination_date").agg(
        F.count_distinct("id_2").alias("schools"),
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("vaccine_group") == "error").alias("failures"),
    )


def _constructed(spark, sf_dir):
    """Line items as ledger events of all types."""
    items = views.table(spark, sf_dir, "lineitem")
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    made = None
    for number, (event_type, fields) in enumerate(EVENT_FIELDS.items()):
        fields = fields or ["files_transformed", "new_records"]
        values = {name: part if position % 2 else order for position, name in enumerate(fields)}
        one = event(event_type, **values)
        hit = (order + F.col("l_linenumber")) % len(EVENT_FIELDS) == number
        made = F.when(hit, one) if made is None else made.when(hit, one)
    return items.select("l_orderkey", "l_linenumber", "l_shipdate", made.alias("e"))


def event_constructors(spark, sf_dir):
    return _constructed(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.col("e.type").alias("type"),
        detail(F.col("e.data")).alias("detail"),
    )


def event_payload_json(spark, sf_dir):
    """Payload text parsed, and a payload written as text."""
    k = F.from_json("props", "k bigint")["k"]
    made = payload("ImportConfirmed", file_name=k, how=F.col("event_type"))
    return views.table(spark, sf_dir, "events").select(
        "event_id", k.alias("k"), F.to_json(made).alias("data")
    )


def _written_ledger(spark, sf_dir):
    """Orders as ledger events, written as JSON by month."""
    orders = views.table(spark, sf_dir, "orders")
    kind = (
        F.when(F.col("o_orderstatus") == "F", event("RunFailed", step=F.col("o_orderstatus"),
                                                    error=F.col("o_orderpriority")))
        .when(F.col("o_orderstatus") == "O", event("RunCompleted", records=F.col("o_orderkey")))
        .otherwise(event("RunStarted", kind=F.lit("run"), trigger=F.lit("scheduled")))
    )
    rows = orders.select(
        F.format_string("run_%d", F.col("o_custkey") % 100).alias("run_id"),
        F.col("o_orderkey").cast("int").alias("seq"),
        kind.alias("e"),
        F.col("o_orderdate").alias("at"),
    ).select("run_id", "seq", "e.type", "at", "e.data")
    path = scratch_path(spark, "ledger")
    # One writer per month, so that a month is few files.
    ledger.append(rows.repartition(F.year("at"), F.month("at")), path)
    return path


def ledger_months(spark, sf_dir):
    """A ledger of many months, of which two are read."""
    months = month_window(dt.date(2000, 1, 15))
    return ledger.read(spark, _written_ledger(spark, sf_dir), months).select(
        "run_id", "seq", "type", "at", detail(F.col("data")).alias("detail")
    )


def status_report(spark, sf_dir):
    """The newest runs of a written ledger and how they ended."""
    return runs.status_report(ledger.read(spark, _written_ledger(spark, sf_dir)), 10)


# --- deliveries --------------------------------------------------------------


def outstanding_files(spark, sf_dir):
    acks = views.file_acks(spark, sf_dir)
    return reconcile.outstanding(acks, ["file_name"]).orderBy("file_name")


def file_ack_status(spark, sf_dir):
    return reconcile.file_status(
        views.file_acks(spark, sf_dir), views.files_present(spark, sf_dir), F.lit(views.AS_OF)
    )


def import_confirmations(spark, sf_dir):
    status = reconcile.file_status(
        views.file_acks(spark, sf_dir), views.files_present(spark, sf_dir), F.lit(views.AS_OF)
    )
    made = reconcile.confirmations(status)
    return made.select("file_name", "type", detail(F.col("data")).alias("detail"))


def already_delivered(spark, sf_dir):
    """Daily diffs some run delivered before with the same content."""
    known, current = views.known_and_current(spark, sf_dir)
    on = ["vaccination_date", "fingerprint"]
    done = fingerprint(known, ["vaccination_date"])
    made = fingerprint(current, ["vaccination_date"])
    return runs.already_delivered(made, done, on).withColumn(
        "fingerprint", F.col("fingerprint").cast("string")
    )


# --- sources -----------------------------------------------------------------


def _config(spark, sf_dir):
    """Regions as districts, their nations as schools, as JSON documents."""
    nations = views.table(spark, sf_dir, "nation")
    regions = views.table(spark, sf_dir, "region")
    key = F.col("n_nationkey").cast("string")
    school = F.struct(
        F.col("n_name").alias("name"),
        key.alias("id"),
        F.lit("N").alias("classification"),
        F.concat(F.lit("contact@"), F.lower("n_name")).alias("email"),
        F.concat(F.lit("rosters/"), key, F.lit(".csv")).alias("bulk_query_file"),
    )
    path = scratch_path(spark, "config")
    (
        nations.join(regions, nations.n_regionkey == regions.r_regionkey)
        .groupBy("r_regionkey", "r_name")
        .agg(F.sort_array(F.collect_list(school)).alias("schools"))
        .select(
            F.struct(F.col("r_regionkey").cast("string").alias("iddis")).alias("district"),
            F.struct(
                F.concat(F.lower("r_name"), F.lit(".invalid")).alias("s3_upload_host"),
            ).alias("api"),
            "schools",
        )
        # One document per file, as configuration is kept.
        .repartition("district")
        .write.option("maxRecordsPerFile", 1)
        .json(path)
    )
    return dimension.read_config(spark, path)


def _listings(spark, sf_dir):
    """Orders of a nation's customers as its results listing, in pages."""
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("c_nationkey").cast("string").alias("school_id"), "o_orderkey", "o_orderdate"
    )
    key = F.col("o_orderkey").cast("string")
    entry = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("school_id").alias("schoolId"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("uploadDateTime"),
        F.concat(F.lit("https://files.invalid/"), key).alias("fullVaccineFileUrl"),
        F.concat(key, F.lit(".csv")).alias("fullVaccineFileName"),
    )
    pages = numbering.segments(rows, ["school_id"], ["o_orderkey"], entry, per_segment=100)
    return pages.select("school_id", "segment", F.to_json("items").alias("body"))


def _latest(spark, sf_dir, listed_since):
    entries = dimension.listing_entries(_listings(spark, sf_dir), "school_id", "body")
    if listed_since:
        entries = entries.filter(F.col("uploaded") >= _millis(listed_since))
    return coverage.latest(entries, ["school_id"], "url", ["uploaded", "url"])


def _millis(day):
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=dt.timezone.utc).timestamp()) * 1000


def latest_per_source(spark, sf_dir):
    rows = views.records(spark, sf_dir)
    return coverage.latest(rows, ["id_2"], "event_id", ["ts", "event_id"])


def latest_listing(spark, sf_dir):
    return _latest(spark, sf_dir, None)


def source_coverage(spark, sf_dir):
    """Every configured school with its latest result since a day."""
    schools = dimension.schools(_config(spark, sf_dir))
    latest = _latest(spark, sf_dir, LISTED_SINCE)
    return coverage.with_latest(schools, latest, "school_id", "url").select(
        "district_id", "school_id", "school_name", "url", "staged"
    )


def readiness_counts(spark, sf_dir):
    """Schools of each district with and without results since a day."""
    schools = dimension.schools(_config(spark, sf_dir))
    latest = _latest(spark, sf_dir, LISTED_SINCE)
    covered = coverage.with_latest(schools, latest, "school_id", "url")
    return coverage.staged_counts(covered, ["district_id"])


def district_customers(spark, sf_dir):
    """Each district's upload identity with the customers of its schools."""
    config = _config(spark, sf_dir)
    customers = views.table(spark, sf_dir, "customer").groupBy(
        F.col("c_nationkey").cast("string").alias("school_id")
    ).agg(F.count(F.lit(1)).alias("customers"))
    counted = (
        dimension.schools(config)
        .join(customers, "school_id", "left")
        .groupBy("district_id")
        .agg(F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"))
    )
    return dimension.district(config).join(
        counted, F.col("iddis") == F.col("district_id")
    ).select("iddis", "s3_upload_host", "customers")


def roster_files(spark, sf_dir):
    """Schools with their roster files, written from their customers' ids,
    1000 to a file; a school without customers has none."""
    path = scratch_path(spark, "rosters")
    customers = views.table(spark, sf_dir, "customer")
    numbered = numbering.sequence(
        customers.select("c_nationkey", "c_custkey"), ["c_nationkey"], ["c_custkey"]
    )
    lines = numbered.select(
        F.concat(F.lit("roster-"), F.col("c_nationkey").cast("string")).alias("roster"),
        (F.floor((F.col("seq") - 1) / F.lit(1000)) + 1).cast("int").alias("part"),
        "seq",
        F.col("c_custkey").cast("string").alias("value"),
    )
    (
        lines.repartition("roster", "part")
        .sortWithinPartitions("roster", "part", "seq")
        .select("roster", "part", "value")
        .write.partitionBy("roster", "part")
        .text(path, lineSep="\n")
    )
    found = files.file_sha256(spark, path).select(
        F.regexp_extract("path", r"/roster=roster-([0-9]+)/", 1).alias("path"),
        F.regexp_extract("path", r"/part=([0-9]+)/", 1).cast("int").alias("part"),
        "sha256",
        "length",
    )
    schools = dimension.schools(_config(spark, sf_dir))
    key = F.regexp_extract("query_file", r"^rosters/([0-9]+)\.csv$", 1)
    return coverage.with_files(schools, found, key).select(
        "school_id", "query_file", "part", "sha256", "length"
    )


def submission_gap(spark, sf_dir):
    """Customers without an order in a period."""
    expected = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("school_id"), "c_name"
    )
    orders = views.table(spark, sf_dir, "orders")
    submitted = orders.filter(period(F.col("o_orderdate")) == PERIOD).select(
        F.col("o_custkey").alias("school_id")
    )
    return coverage.not_submitted(expected, submitted, ["school_id"])


QUERIES = {
    "recent_by_month": recent_by_month,
    "folded_months": folded_months,
    "run_sequence": run_sequence,
    "run_timeline": run_timeline,
    "run_summary": run_summary,
    "recent_runs": recent_runs,
    "recent_run_events": recent_run_events,
    "claim_winner": claim_winner,
    "run_totals": run_totals,
    "event_constructors": event_constructors,
    "event_payload_json": event_payload_json,
    "ledger_months": ledger_months,
    "status_report": status_report,
    "outstanding_files": outstanding_files,
    "file_ack_status": file_ack_status,
    "import_confirmations": import_confirmations,
    "already_delivered": already_delivered,
    "latest_per_source": latest_per_source,
    "latest_listing": latest_listing,
    "source_coverage": source_coverage,
    "readiness_counts": readiness_counts,
    "district_customers": district_customers,
    "roster_files": roster_files,
    "submission_gap": submission_gap,
}

_SUMMARY = f"""{RUNS_SQL},
summary as (
  select run_id, arg_min("at", seq) as started, arg_max("at", seq) as ended, count(*) as events,
         case when arg_max(type, seq) in ('purchase', 'signup', 'error')
              then arg_max(type, seq) else 'NO TERMINAL EVENT' end as outcome
  from runs group by run_id)"""

_OUTSTANDING = f"""{ACKS_SQL},
outstanding as (
  select file_name from acks group by file_name
  having bool_or(delivered) and not bool_or(confirmed)),
status as (
  select file_name,
         cast(date_diff('day', cast(file_name[1:10] as date), date '2024-01-31') as int)
           as age_days,
         case when file_name not in (select file_name from present) then 'imported'
              when date_diff('day', cast(file_name[1:10] as date), date '2024-01-31') >= 7
                then 'overdue' else 'awaiting' end as status
  from outstanding)"""

_LISTED = """
with entries as (
  select cast(c_nationkey as varchar) as school_id,
         'https://files.invalid/' || o_orderkey as url, o_orderdate
  from orders join customer on o_custkey = c_custkey),
recent as (
  select school_id, arg_max(url, (o_orderdate, url)) as url from entries
  where o_orderdate >= timestamp '2001-07-25' group by school_id),
schools as (
  select cast(n_regionkey as varchar) as district_id, cast(n_nationkey as varchar) as school_id,
         n_name as school_name from nation)"""

_TYPES = list(EVENT_FIELDS)


def _detail_sql(fields):
    columns = ["l_orderkey", "l_partkey"]
    pairs = [f"'{name}=' || {columns[i % 2]}" for i, name in enumerate(fields)]
    return " || ', ' || ".join(pairs)


_POSITIONS = {
    name: i
    for fields in EVENT_FIELDS.values()
    for i, name in enumerate(fields or ["files_transformed", "new_records"])
}
_CONSTRUCTED = "\n".join(
    f"when {number} then "
    + _detail_sql(fields or ["files_transformed", "new_records"])
    for number, fields in enumerate(EVENT_FIELDS.values())
)
_LEDGER = """
with ledger as (
  select 'run_' || (o_custkey % 100) as run_id, cast(o_orderkey as int) as seq,
         case o_orderstatus when 'F' then 'RunFailed' when 'O' then 'RunCompleted'
              else 'RunStarted' end as type,
         o_orderdate as "at",
         case o_orderstatus
           when 'F' then 'step=' || o_orderstatus || ', error=' || o_orderpriority
           when 'O' then 'records=' || o_orderkey
           else 'kind=run, trigger=scheduled' end as detail
  from orders)"""

_SETS = views.sets_sql()

_RUN_ORDERS = f"""
with events as (
  select printf('run_%05d', date_diff('day', date '1970-01-01', cast(o_orderdate as date)) // {RUN_DAYS}) as run_id,
         'Order' || o_orderstatus as type, o_orderdate as "at", o_orderkey as order_key,
         row_number() over (partition by date_diff('day', date '1970-01-01', cast(o_orderdate as date)) // {RUN_DAYS}
                            order by o_orderdate, o_orderkey) as seq
  from orders)"""

SQL = {
    "recent_by_month": f"""{_RUN_ORDERS}
select run_id, seq, type, order_key from events where run_id in (
  select run_id from events where seq = 1 order by "at" desc, run_id limit {RECENT})""",
    "folded_months": f"""{_RUN_ORDERS}
select year("at") as year, month("at") as month, type, count(*) as events,
       count(*) filter (seq = 1) as started, sum(order_key)::bigint as order_keys
from events group by 1, 2, 3""",
    "run_sequence": f"""{RUNS_SQL}
select event_id, run_id, seq, printf('%03d_%s.json', seq, type) as name from runs""",
    "run_timeline": """
with numbered as (
  select user_id, event_type,
         row_number() over (partition by user_id order by ts, event_id) as seq
  from events)
select user_id, cast((seq - 1) // 100 + 1 as bigint) as segment,
       string_agg(event_type, '>' order by seq) as timeline
from numbered group by 1, 2""",
    "run_summary": f"{_SUMMARY} select * from summary",
    "recent_runs": f"{_SUMMARY} select * from summary order by started desc, run_id limit 10",
    "recent_run_events": f"""{_SUMMARY}
select run_id, seq, type from runs where run_id in (
  select run_id from summary order by started desc, run_id limit 10)""",
    "claim_winner": """
select event_type, cast(ts as date) as day, arg_min(user_id, (ts, user_id)) as run_id,
       min(ts) as "at", count(*) as attempts
from events group by 1, 2""",
    "run_totals": f"""
select vaccination_date, count(distinct id_2) as schools, count(*) as records,
       count(*) filter (where vaccine_group = 'error') as failures
from ({views.RECORDS_SQL}) group by 1""",
    "event_constructors": f"""
select l_orderkey, l_linenumber,
       {_TYPES!r}[(l_orderkey + l_linenumber) % {len(_TYPES)} + 1] as type,
       case (l_orderkey + l_linenumber) % {len(_TYPES)}
       {_CONSTRUCTED} end as detail
from lineitem""",
    "event_payload_json": """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
       '{"file_name":"' || json_extract_string(props, '$.k') || '","how":"'
         || event_type || '"}' as data
from events""",
    "ledger_months": f"""{_LEDGER}
select * from ledger
where "at" >= timestamp '1999-12-01' and "at" < timestamp '2000-02-01'""",
    "status_report": f"""{_LEDGER}
select arg_min("at", seq) as started, run_id,
       case when arg_max(type, seq) in ({", ".join(repr(t) for t in TERMINAL_TYPES)})
            then arg_max(type, seq) else 'NO TERMINAL EVENT' end as outcome,
       case when arg_max(type, seq) in ({", ".join(repr(t) for t in TERMINAL_TYPES)})
            then arg_max(detail, seq) else 'last event: ' || arg_max(type, seq) end as detail
from ledger group by run_id order by started desc, run_id limit 10""",
    "outstanding_files": f"{_OUTSTANDING} select file_name from outstanding",
    "file_ack_status": f"{_OUTSTANDING} select * from status",
    "import_confirmations": f"""{_OUTSTANDING}
select file_name, 'ImportConfirmed' as type,
       'file_name=' || file_name || ', how=deleted from Drive' as detail
from status where status = 'imported'""",
    "already_delivered": f"""{_SETS},
done as (select vaccination_date, sum({DIGEST_SQL}) as fingerprint from known group by 1),
made as (select vaccination_date, count(*) as records, sum({DIGEST_SQL}) as fingerprint
         from current group by 1)
select vaccination_date, cast(fingerprint as varchar) as fingerprint, records
from made join done using (vaccination_date, fingerprint)""",
    "latest_per_source": f"""
select id_2, arg_max(event_id, (ts, event_id)) as event_id, count(*) as entries
from ({views.RECORDS_SQL}) group by id_2""",
    "latest_listing": f"""{_LISTED}
select school_id, arg_max(url, (o_orderdate, url)) as url, count(*) as entries
from entries group by school_id""",
    "source_coverage": f"""{_LISTED}
select district_id, school_id, school_name, url, url is not null as staged
from schools left join recent using (school_id)""",
    "readiness_counts": f"""{_LISTED}
select district_id, count(*) as school_count, count(url) as staged,
       count(*) - count(url) as missing
from schools left join recent using (school_id) group by district_id""",
    "district_customers": """
select cast(r_regionkey as varchar) as iddis, lower(r_name) || '.invalid' as s3_upload_host,
       count(c_custkey) as customers
from region join nation on n_regionkey = r_regionkey
left join customer on c_nationkey = n_nationkey group by 1, 2""",
    "roster_files": """
with numbered as (
  select c_nationkey, c_custkey,
         (row_number() over (partition by c_nationkey order by c_custkey) - 1) // 1000 + 1 as part
  from customer),
bodies as (
  select c_nationkey, cast(part as int) as part,
         string_agg(cast(c_custkey as varchar), chr(10) order by c_custkey) || chr(10) as body
  from numbered group by 1, 2)
select cast(n_nationkey as varchar) as school_id,
       'rosters/' || n_nationkey || '.csv' as query_file, part, sha256(body) as sha256,
       octet_length(encode(body)) as length
from nation left join bodies on c_nationkey = n_nationkey""",
    "submission_gap": f"""
select c_custkey as school_id, c_name from customer where c_custkey not in (
  select o_custkey from orders where strftime(o_orderdate, '%Y-%m') = '{PERIOD}')""",
}
