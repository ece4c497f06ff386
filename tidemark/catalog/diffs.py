"""Record algebra, fingerprints, gates and numbering."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import views
from tidemark.catalog.views import DIGEST_SQL, KEYS, LINE_SQL, RECORDS_SQL, SHIPMENTS_SQL
from tidemark.functions.digest import digest_sum, fingerprint, record_line
from tidemark.operators import gate, numbering, records
from tidemark.plans.store import Store
from tidemark.schema import KEY
from tidemark.session import scratch_path, stage
from tidemark.sources.master import describe

SHIPPED_KNOWN_UNTIL = "1999-01-01"
SHIPPED_CURRENT_FROM = "1998-07-01"


def record_projection(spark, sf_dir):
    return views.records(spark, sf_dir).select(*KEY)


def dedupe_records(spark, sf_dir):
    return records.dedupe(views.records(spark, sf_dir))


def dedupe_first_seen(spark, sf_dir):
    return records.first_seen(views.records(spark, sf_dir), "event_id")


def union_master(spark, sf_dir):
    known, current = views.known_and_current(spark, sf_dir)
    return records.union(known, current)


def master_advance(spark, sf_dir):
    """Known and new side by side: no dedupe is needed to get the union."""
    known, current = views.known_and_current(spark, sf_dir)
    return records.advance(known, records.diff(current, known))


def new_records(spark, sf_dir):
    known, current = views.known_and_current(spark, sf_dir)
    return records.diff(current, known)


def new_records_semi_anti(spark, sf_dir):
    """The shape for a measured batch; here it fits a broadcast."""
    known, current = views.known_and_current(spark, sf_dir)
    current = stage(current, "current")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return records.new_records(current, known, records.measure(current), partitions)


def new_records_bucketed(spark, sf_dir):
    """A batch hashed against a bucketed master that is not shuffled."""
    known, current = views.known_and_current(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "bucketed"))
    known = stage(known, "known")
    segment, count, digest = describe(known)
    store.master.write_segment(known, segment)
    version = store.version().plus(segment, count, digest)
    return records.diff_hashed(stage(current, "current"), store.master.read(version))


def known_hits(spark, sf_dir):
    known, current = views.known_and_current(spark, sf_dir)
    return records.hits(current, known)


def diff_counts(spark, sf_dir):
    known, current = views.known_and_current(spark, sf_dir)
    new = records.diff(current, known)
    return records.counts(current, known, new, ["id_2"])


def new_records_per_source(spark, sf_dir):
    known, current = views.known_and_current(spark, sf_dir)
    return (
        records.diff(current, known)
        .groupBy("id_2")
        .agg(F.count(F.lit(1)).alias("new_count"))
    )


def _as_text(printed):
    return printed.withColumn("fingerprint", F.col("fingerprint").cast("string"))


def set_fingerprint(spark, sf_dir):
    known, current = views.known_and_current(spark, sf_dir)
    return _as_text(fingerprint(records.diff(current, known)))


def source_fingerprints(spark, sf_dir):
    return _as_text(fingerprint(records.dedupe(views.records(spark, sf_dir)), ["id_2"]))


def line_bytes(spark, sf_dir):
    return (
        views.records(spark, sf_dir)
        .groupBy("id_2")
        .agg(F.sum(F.octet_length(record_line())).cast("long").alias("bytes"))
    )


def volume_gate(spark, sf_dir):
    known, current = views.known_and_current(
        spark, sf_dir, views.GATE_KNOWN_UNTIL, views.GATE_CURRENT_FROM
    )
    new = records.diff(current, known)
    counted = records.counts(current, known, new, ["id_2"])
    share = F.lit(views.GATE_SHARE)
    return counted.select(
        "id_2",
        "new_count",
        "known_count",
        gate.gate_limit(F.col("known_count"), share).alias("gate_limit"),
        gate.suspicious(F.col("new_count"), F.col("known_count"), share).alias("blocked"),
        gate.suspicious(
            F.col("new_count"), F.col("known_count"), F.lit(None).cast("double")
        ).alias("blocked_when_off"),
    )


def _states(spark, sf_dir):
    """A run state per customer, counted from orders and their line items."""
    orders = views.table(spark, sf_dir, "orders")
    items = views.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lines")
    )
    joined = orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
    n = F.count(F.lit(1))
    lines = F.coalesce(F.sum("lines"), F.lit(0))
    return joined.groupBy("o_custkey").agg(
        (n % 7 != 0).alias("query_submitted"),
        F.count_if(F.col("o_orderstatus") == "F").alias("staged"),
        (n - n % 3).alias("school_count"),
        (n % 5 != 0).alias("staging_deadline_passed"),
        (n % 4 != 0).alias("has_diff"),
        (lines * (n % 6)).alias("new_count"),
        (lines * 4 * (n % 11)).alias("known_count"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("files_transformed"),
        F.count_if(F.col("o_orderpriority") == "5-LOW").alias("fetch_failures"),
        (F.max("o_orderkey") % 2 == 0).alias("delivered"),
        (F.max("o_orderkey") % 3 == 0).alias("delivered_elsewhere"),
        (F.max("o_orderkey") % 5 != 0).alias("master_committed"),
    )


def decision_table(spark, sf_dir):
    return _states(spark, sf_dir).select(
        "o_custkey",
        gate.next_step(F.lit(0.2)).alias("s"),
        gate.completeness(
            F.col("staged"), F.col("school_count"), F.col("staging_deadline_passed")
        ).alias("sources"),
    ).select("o_custkey", "s.action", "s.status", "s.step", "s.error", "sources")


def terminal_events(spark, sf_dir):
    """The event that ends each run that is decided to its end."""
    decided = _states(spark, sf_dir).select(
        "o_custkey", "new_count", "files_transformed", gate.next_step(F.lit(0.2)).alias("s")
    )
    made = gate.terminal_event(
        F.col("s.status"),
        F.col("s.step"),
        F.col("s.error"),
        F.lit("delivered by another run"),
        files_transformed=F.col("files_transformed"),
        new_records=F.col("new_count"),
    )
    return (
        decided.filter(F.col("s.action") == "finish")
        .select("o_custkey", made.alias("e"))
        .select("o_custkey", F.col("e.type").alias("type"), F.to_json("e.data").alias("data"))
    )


def chunk_assign(spark, sf_dir):
    distinct = stage(records.dedupe(views.records(spark, sf_dir)), "distinct")
    return numbering.chunks(distinct, KEY, 1000).rows.select(*KEY, "chunk_no")


def chunk_sizes(spark, sf_dir):
    distinct = stage(records.dedupe(views.records(spark, sf_dir)), "distinct")
    rows = numbering.chunks(distinct, KEY, 1000).rows
    return rows.groupBy("chunk_no").agg(F.count(F.lit(1)).alias("records"))


def _shipments(spark, sf_dir):
    rows = views.shipments(spark, sf_dir)
    day = F.col("vaccination_date")
    known = rows.filter(day < F.lit(SHIPPED_KNOWN_UNTIL).cast("date"))
    current = rows.filter(day >= F.lit(SHIPPED_CURRENT_FROM).cast("date"))
    return records.dedupe(known), records.dedupe(current)


def shipments_dedupe(spark, sf_dir):
    return records.dedupe(views.shipments(spark, sf_dir))


def shipments_new(spark, sf_dir):
    known, current = _shipments(spark, sf_dir)
    current = stage(current, "current")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return records.new_records(current, known, records.measure(current), partitions)


def shipments_fingerprint(spark, sf_dir):
    distinct = records.dedupe(views.shipments(spark, sf_dir))
    return distinct.groupBy("vaccine_group").agg(
        F.count(F.lit(1)).alias("records"),
        digest_sum(record_line()).cast("string").alias("fingerprint"),
    )


def shipments_chunks(spark, sf_dir):
    distinct = stage(records.dedupe(views.shipments(spark, sf_dir)), "distinct")
    rows = numbering.chunks(distinct, KEY, 10_000).rows
    return rows.groupBy("chunk_no").agg(
        F.count(F.lit(1)).alias("records"), F.min("id_1").alias("first_id")
    )


QUERIES = {
    "record_projection": record_projection,
    "dedupe_records": dedupe_records,
    "dedupe_first_seen": dedupe_first_seen,
    "union_master": union_master,
    "master_advance": master_advance,
    "new_records": new_records,
    "new_records_per_source": new_records_per_source,
    "new_records_semi_anti": new_records_semi_anti,
    "new_records_bucketed": new_records_bucketed,
    "known_hits": known_hits,
    "diff_counts": diff_counts,
    "set_fingerprint": set_fingerprint,
    "source_fingerprints": source_fingerprints,
    "line_bytes": line_bytes,
    "volume_gate": volume_gate,
    "decision_table": decision_table,
    "terminal_events": terminal_events,
    "chunk_assign": chunk_assign,
    "chunk_sizes": chunk_sizes,
    "shipments_dedupe": shipments_dedupe,
    "shipments_new": shipments_new,
    "shipments_fingerprint": shipments_fingerprint,
    "shipments_chunks": shipments_chunks,
}

_SETS = views.sets_sql()
_GATE_SETS = views.sets_sql(views.GATE_KNOWN_UNTIL, views.GATE_CURRENT_FROM)
_COUNTED = """, counted as (
  select id_2, count(*) filter (where s = 'new') as new_count,
         count(*) filter (where s = 'current') as total_count,
         count(*) filter (where s = 'known') as known_count,
         count(*) filter (where s in ('known', 'new')) as record_count
  from (select id_2, 'new' as s from new union all
        select id_2, 'current' from current union all
        select id_2, 'known' from known) group by id_2)"""

_STATES_SQL = """
with counted as (
  select o_custkey, count(*) as n, coalesce(sum(lines), 0) as lines,
         count(*) filter (where o_orderstatus = 'F') as staged,
         count(*) filter (where o_orderpriority = '1-URGENT') as files_transformed,
         count(*) filter (where o_orderpriority = '5-LOW') as fetch_failures,
         max(o_orderkey) as top
  from orders left join (select l_orderkey, count(*) as lines from lineitem group by 1) i
    on l_orderkey = o_orderkey
  group by o_custkey),
states as (
  select *, n % 7 <> 0 as query_submitted, n - n % 3 as school_count,
         n % 5 <> 0 as deadline, n % 4 <> 0 as has_diff,
         cast(lines * (n % 6) as bigint) as new_count,
         cast(lines * 4 * (n % 11) as bigint) as known_count,
         top % 2 = 0 as delivered, top % 3 = 0 as elsewhere, top % 5 <> 0 as committed
  from counted),
decided as (
  select *, case
    when not query_submitted then 'submit_queries|||'
    when staged < school_count and not deadline then 'awaiting_results|||'
    when staged = 0 then 'finish|failed|awaiting_results|NoResultsStaged'
    when not has_diff then 'compute_diff|||'
    when files_transformed = 0 and fetch_failures > 0
      then 'finish|failed|fetch|AllDownloadsFailed'
    when new_count = 0 then 'finish|success||'
    when known_count > 0 and new_count > greatest(50, floor(cast(0.2 as double) * known_count))
      then 'finish|blocked|diff_sanity|SuspiciousDiffVolume'
    when not delivered then 'deliver_diff|||'
    when not committed then 'commit_master|||'
    when elsewhere then 'finish|skipped||'
    else 'finish|success||' end as d
  from states)"""

_SHIPPED = f"""
with records as ({SHIPMENTS_SQL}),
known as (select distinct {KEYS} from records
          where vaccination_date < date '{SHIPPED_KNOWN_UNTIL}'),
current as (select distinct {KEYS} from records
            where vaccination_date >= date '{SHIPPED_CURRENT_FROM}')"""

SQL = {
    "record_projection": f"select {KEYS} from ({RECORDS_SQL})",
    "dedupe_records": f"select distinct {KEYS} from ({RECORDS_SQL})",
    "dedupe_first_seen": (
        f"select {KEYS}, min(event_id) as first_seen from ({RECORDS_SQL}) group by {KEYS}"
    ),
    "union_master": f"{_SETS} select * from known union select * from current",
    "master_advance": f"{_SETS} select * from known union select * from current",
    "new_records": f"{_SETS} select {KEYS} from new",
    "new_records_per_source": f"{_SETS} select id_2, count(*) as new_count from new group by id_2",
    "new_records_semi_anti": f"{_SETS} select {KEYS} from new",
    "new_records_bucketed": f"{_SETS} select {KEYS} from new",
    "known_hits": f"{_SETS} select * from current intersect select * from known",
    "diff_counts": f"{_SETS}{_COUNTED} select * from counted",
    "set_fingerprint": f"""{_SETS}
select count(*) as records, cast(sum({DIGEST_SQL}) as varchar) as fingerprint from new""",
    "source_fingerprints": f"""
select id_2, count(*) as records, cast(sum({DIGEST_SQL}) as varchar) as fingerprint
from (select distinct {KEYS} from ({RECORDS_SQL})) group by id_2""",
    "line_bytes": f"""
select id_2, cast(sum(octet_length(encode({LINE_SQL}))) as bigint) as bytes
from ({RECORDS_SQL}) group by id_2""",
    "volume_gate": f"""{_GATE_SETS}{_COUNTED},
limited as (
  select *, cast(greatest(50, floor(cast({views.GATE_SHARE} as double) * known_count)) as bigint)
         as gate_limit from counted)
select id_2, new_count, known_count, gate_limit,
       known_count > 0 and new_count > gate_limit as blocked, false as blocked_when_off
from limited""",
    "decision_table": f"""{_STATES_SQL}
select o_custkey, split_part(d, '|', 1) as action, split_part(d, '|', 2) as status,
       split_part(d, '|', 3) as step, split_part(d, '|', 4) as error,
       case when staged >= school_count then 'full' when not deadline then 'waiting'
            when staged > 0 then 'partial' else 'none' end as sources
from decided""",
    "terminal_events": f"""{_STATES_SQL}
select o_custkey,
       case split_part(d, '|', 2) when 'success' then 'RunCompleted'
            when 'skipped' then 'RunSkipped' else 'RunFailed' end as type,
       case split_part(d, '|', 2)
         when 'success' then '{{"files_transformed":"' || files_transformed
           || '","new_records":"' || new_count || '"}}'
         when 'skipped' then '{{"reason":"delivered by another run"}}'
         else '{{"step":"' || split_part(d, '|', 3) || '","error":"'
           || split_part(d, '|', 4) || '"}}' end as data
from decided where split_part(d, '|', 1) = 'finish'""",
    "chunk_assign": f"""
select *, cast((row_number() over (order by {KEYS}) - 1) // 1000 + 1 as bigint) as chunk_no
from (select distinct {KEYS} from ({RECORDS_SQL}))""",
    "chunk_sizes": f"""
select chunk_no, count(*) as records from (
  select cast((row_number() over (order by {KEYS}) - 1) // 1000 + 1 as bigint) as chunk_no
  from (select distinct {KEYS} from ({RECORDS_SQL}))) group by chunk_no""",
    "shipments_dedupe": f"select distinct {KEYS} from ({SHIPMENTS_SQL})",
    "shipments_new": f"{_SHIPPED} select * from current except select * from known",
    "shipments_fingerprint": f"""
select vaccine_group, count(*) as records, cast(sum({DIGEST_SQL}) as varchar) as fingerprint
from (select distinct {KEYS} from ({SHIPMENTS_SQL})) group by vaccine_group""",
    "shipments_chunks": f"""
select chunk_no, count(*) as records, min(id_1) as first_id from (
  select id_1, cast((row_number() over (order by {KEYS}) - 1) // 10000 + 1 as bigint) as chunk_no
  from (select distinct {KEYS} from ({SHIPMENTS_SQL}))) group by chunk_no""",
}
