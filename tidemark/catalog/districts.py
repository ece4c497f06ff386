"""Runs of many districts at once, with their schools by name.

A district is eight users' worth of events (``id_2``), a school one of its five
groups of users.  In the first landing two districts send three days only, and
one nothing; in the second all send what came since, so that the gate stops the
two and lets the others, and a first delivery, pass.  One school has no result,
one's result never landed, one's extract is spoilt, one has no roster.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import views
from tidemark.catalog.views import KEYS, RECORDS_SQL
from tidemark.plans import jobs
from tidemark.plans.fleet import Fleet, run_fleet
from tidemark.plans.store import Store
from tidemark.session import scratch_path, stage
from tidemark.sources import files
from tidemark.sources.extracts import REGISTRY

SCHOOLS = 40
#: Districts with little known, and the one with nothing known.
LITTLE_UNTIL = "2024-01-04"
LITTLE, NOTHING = ("S002", "S005"), "S007"
NO_RESULT, NOT_LANDED, SPOILT, NO_ROSTER = "K01", "K12", "K19", "K22"
FRACTION = 0.9


def _school(user):
    return F.format_string("K%02d", user % SCHOOLS)


def _records(spark, sf_dir):
    """Records with their school; staged, as every landing and the dimension read them."""
    users = views.table(spark, sf_dir, "events").select("event_id", "user_id")
    rows = views.records(spark, sf_dir).join(users, "event_id")
    return stage(rows.withColumn("school_id", _school(F.col("user_id"))).drop("user_id"), "records")


def _dimension(spark, rows):
    """Configuration documents, results listings and roster digests, made from the records."""
    schools = stage(rows.select("id_2", "school_id").distinct(), "schools")
    school = F.struct(
        F.concat(F.lit("School "), "school_id").alias("name"),
        F.col("school_id").alias("id"),
        F.lit("N").alias("classification"),
        F.lit("").alias("email"),
        F.concat("school_id", F.lit(".txt")).alias("bulk_query_file"),
    )
    config = schools.groupBy("id_2").agg(F.collect_list(school).alias("schools")).select(
        F.struct(F.col("id_2").alias("iddis")).alias("district"),
        F.struct(F.lit("host").alias("s3_upload_host")).alias("api"),
        "schools",
    )
    entry = '{"uploadDateTime": %d, "fullVaccineFileUrl": "https://host/%s%s.csv"}'
    earlier = F.format_string(entry, F.lit(1), F.lit("old-"), "school_id")
    newest = F.format_string(entry, F.lit(2), F.lit(""), "school_id")
    body = F.when(F.col("school_id") == NO_RESULT, F.lit("[]")).otherwise(
        F.concat(F.lit("["), newest, F.lit(", "), earlier, F.lit("]"))
    )
    listings = schools.select(F.col("id_2").alias("district_id"), "school_id", body.alias("body"))
    path = scratch_path(spark, "rosters")
    (
        rows.where(F.col("school_id") != NO_ROSTER)
        .select("school_id", F.col("id_1").alias("value")).distinct()
        .repartition("school_id").sortWithinPartitions("school_id", "value")
        .write.partitionBy("school_id").text(path)
    )
    school_of = F.regexp_extract("path", r"/school_id=([^/]+)/", 1)
    rosters = files.file_digests(spark, path).select(
        F.concat(school_of, F.lit(".txt")).alias("path"), F.col("ordered_digest").alias("digest")
    )
    return config, listings, stage(rosters, "rosters")


def _land(spark, rows, spoilt):
    """An extract for each school; one that no listing names holds records, too."""
    path = scratch_path(spark, "landing")
    bad = (F.col("school_id") == SPOILT) & (F.col("event_id") % 3 == 0) & F.lit(spoilt)
    day = F.when(bad, F.lit("someday")).otherwise(F.col("vaccination_date").cast("string"))
    file = F.when(F.col("school_id") == NOT_LANDED, F.lit("stray")).otherwise(F.col("school_id"))
    (
        rows.withColumn("file_name", F.concat(file, F.lit(".csv")))
        .select("file_name", "id_1", "id_2", F.col("vaccine_group").alias("vaccine_group_name"),
                day.alias("vaccination_date"))
        .repartition("file_name")
        .write.partitionBy("file_name").option("header", "true").option("sep", "|").csv(path)
    )
    return [f"{path}/*/part-*"]


def _two_landings(spark, sf_dir):
    fleet = Fleet(spark, scratch_path(spark, "fleet"))
    rows = _records(spark, sf_dir)
    config, listings, rosters = _dimension(spark, rows)
    until = F.when(F.col("id_2").isin(*LITTLE), F.lit(LITTLE_UNTIL)).otherwise(F.lit(views.KNOWN_UNTIL))
    known = rows.where((F.col("ts") < until.cast("timestamp_ntz")) & (F.col("id_2") != NOTHING))
    first = _land(spark, known, False)
    run_fleet(fleet, config, listings, rosters, first, REGISTRY, dt.date(2024, 1, 21), fraction=None)
    current = _land(spark, views.since(rows, views.CURRENT_FROM), True)
    told = run_fleet(
        fleet, config, listings, rosters, current, REGISTRY, views.AS_OF, fraction=FRACTION, run_id="second"
    )
    return fleet, told


def fleet_run(spark, sf_dir):
    """How the second run went in each district."""
    return _two_landings(spark, sf_dir)[1].drop("run_id")


def fleet_master(spark, sf_dir):
    """What each district's master holds after both runs."""
    return _two_landings(spark, sf_dir)[0].known()


def fleet_sources(spark, sf_dir):
    """Events of the second run's schools by name, and what failed at which step."""
    fleet, _ = _two_landings(spark, sf_dir)
    data = F.col("data")
    return fleet.events().where(
        F.col("run_id").startswith("second") & F.col("type").isin("QuerySubmitted", "RecordsFetched", "SourceFailed")
    ).select(
        F.substring_index("run_id", "@", -1).alias("district_id"),
        data["school_id"].alias("school_id"), "type",
        F.coalesce(data["step"], F.lit("")).alias("step"),
        F.coalesce(data["error"], F.lit("")).alias("error"),
    )


def readiness_run(spark, sf_dir):
    """Readiness as a run: its events, and the counts in the last one."""
    store = Store(spark, scratch_path(spark, "store"))
    config, listings, _ = _dimension(spark, _records(spark, sf_dir))
    jobs.run_readiness(store, config, listings)
    data = F.col("data")
    return store.events().select(
        "seq", "type", F.coalesce(data["kind"], F.lit("")).alias("kind"),
        data["schools_checked"].cast("long").alias("schools_checked"),
        data["records_available"].cast("long").alias("records_available"),
    )


QUERIES = {
    "fleet_run": fleet_run,
    "fleet_master": fleet_master,
    "fleet_sources": fleet_sources,
    "readiness_run": readiness_run,
}

_LITTLE = ", ".join(f"'{name}'" for name in LITTLE)
_RUNS = f"""
with records as (
  select e.user_id, r.*, printf('K%02d', e.user_id % {SCHOOLS}) as school_id
  from ({RECORDS_SQL}) r join events e using (event_id)),
landed as (select * from records where school_id not in ('{NO_RESULT}', '{NOT_LANDED}')),
known as (
  select distinct {KEYS} from landed
  where ts < case when id_2 in ({_LITTLE}) then timestamp '{LITTLE_UNTIL}'
                  else timestamp '{views.KNOWN_UNTIL}' end and id_2 <> '{NOTHING}'),
came as (select * from landed where ts >= timestamp '{views.CURRENT_FROM}'),
spoilt as (select distinct school_id from came where school_id = '{SPOILT}' and event_id % 3 = 0),
batch as (select distinct {KEYS} from came where school_id not in (select school_id from spoilt)),
new as (select * from batch except select * from known),
schools as (
  select distinct id_2, school_id,
         school_id in (select school_id from came) as fetched,
         school_id in (select school_id from came) and school_id not in (select school_id from spoilt)
           as accepted
  from records),
counted as (
  select id_2, count(*) as school_count, count(*) filter (school_id <> '{NO_RESULT}') as staged,
         count(*) filter (accepted) as files_transformed,
         count(*) filter (not accepted) as fetch_failures,
         count(*) filter (school_id = '{NO_ROSTER}') as submission_failures
  from schools group by id_2),
metrics as (
  select c.*, (select count(*) from batch b where b.id_2 = c.id_2) as total_count,
         (select count(*) from new n where n.id_2 = c.id_2) as new_count,
         (select count(*) from known k where k.id_2 = c.id_2) as known_count
  from counted c),
decided as (
  select *, case when files_transformed = 0 then 'fetch' when new_count = 0 then ''
                 when known_count > 0 and new_count > greatest(50, floor({FRACTION}::double * known_count))
                   then 'diff_sanity' else '' end as step
  from metrics),
passed as (select id_2 from decided where step = '' and new_count > 0)"""

SQL = {
    "fleet_run": f"""{_RUNS}
select id_2 as district_id,
       case step when 'fetch' then 'failed' when 'diff_sanity' then 'blocked' else 'success' end as status,
       step, case step when 'fetch' then 'AllDownloadsFailed' when 'diff_sanity' then 'SuspiciousDiffVolume'
                  else '' end as error,
       school_count, staged, files_transformed, fetch_failures, submission_failures,
       total_count, new_count, known_count
from decided""",
    "fleet_master": f"""{_RUNS}
select id_2 as district_id, * from known
union all select id_2, * from new where id_2 in (select id_2 from passed)""",
    "fleet_sources": f"""{_RUNS}
select id_2 as district_id, school_id,
       case when school_id = '{NO_ROSTER}' then 'SourceFailed' else 'QuerySubmitted' end as type,
       case when school_id = '{NO_ROSTER}' then 'submit' else '' end as step,
       case when school_id = '{NO_ROSTER}' then 'RosterMissing' else '' end as error
from schools
union all select id_2, school_id, 'RecordsFetched', '', '' from schools where fetched
union all
select id_2, school_id, 'SourceFailed', case when fetched then 'transform' else 'fetch' end,
       case when school_id = '{NO_RESULT}' then 'NoResult' when not fetched then 'ResultNotLanded'
            else 'FileRejected:date' end
from schools where not accepted""",
    "readiness_run": f"""
with schools as (select distinct user_id % {SCHOOLS} as school from events)
select 1::bigint as seq, 'RunStarted' as type, 'readiness' as kind,
       null::bigint as schools_checked, null::bigint as records_available
union all
select 2, 'RunCompleted', '', count(*), count(*) filter (printf('K%02d', school) <> '{NO_RESULT}')
from schools""",
}
