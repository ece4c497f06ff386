"""The given tables seen as records, runs, files and sources.

Every view is a Spark projection beside the SQL that says the same.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.numbering import sequence
from tidemark.operators.records import dedupe
from tidemark.schema import KEY

KEYS = ", ".join(KEY)

# Two overlapping landings: what was known, and what came in.
KNOWN_UNTIL = "2024-01-21"
CURRENT_FROM = "2024-01-15"
# A second pair for the volume gate.
GATE_KNOWN_UNTIL = "2024-01-27"
GATE_CURRENT_FROM = "2024-01-20"
GATE_SHARE = 0.16
AS_OF = dt.date(2024, 1, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- records -----------------------------------------------------------------

RECORDS_SQL = """
select printf('%05d', user_id) as id_1, printf('S%03d', user_id % 8) as id_2,
       event_type as vaccine_group, cast(ts as date) as vaccination_date,
       event_id, ts
from events"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as records, with their event id and time."""
    return table(spark, sf_dir, "events").select(
        F.format_string("%05d", "user_id").alias("id_1"),
        F.format_string("S%03d", F.col("user_id") % 8).alias("id_2"),
        F.col("event_type").alias("vaccine_group"),
        F.col("ts").cast("date").alias("vaccination_date"),
        "event_id",
        "ts",
    )


SHIPMENTS_SQL = """
select printf('%09d', l_orderkey) as id_1, printf('S%06d', l_suppkey) as id_2,
       l_returnflag || l_linestatus as vaccine_group,
       cast(l_shipdate as date) as vaccination_date, l_quantity
from lineitem"""


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as records: the large set."""
    return table(spark, sf_dir, "lineitem").select(
        F.format_string("%09d", "l_orderkey").alias("id_1"),
        F.format_string("S%06d", "l_suppkey").alias("id_2"),
        F.concat("l_returnflag", "l_linestatus").alias("vaccine_group"),
        F.col("l_shipdate").cast("date").alias("vaccination_date"),
        "l_quantity",
    )


def before(rows: DataFrame, day: str) -> DataFrame:
    return rows.filter(F.col("ts") < F.lit(day).cast("timestamp_ntz"))


def since(rows: DataFrame, day: str) -> DataFrame:
    return rows.filter(F.col("ts") >= F.lit(day).cast("timestamp_ntz"))


def known_and_current(
    spark: SparkSession,
    sf_dir: str,
    known_until: str = KNOWN_UNTIL,
    current_from: str = CURRENT_FROM,
) -> tuple[DataFrame, DataFrame]:
    rows = records(spark, sf_dir)
    return dedupe(before(rows, known_until)), dedupe(since(rows, current_from))


def sets_sql(known_until: str = KNOWN_UNTIL, current_from: str = CURRENT_FROM) -> str:
    """``with`` clauses naming the record view, both sets and what is new."""
    return f"""
with records as ({RECORDS_SQL}),
known as (select distinct {KEYS} from records where ts < timestamp '{known_until}'),
current as (select distinct {KEYS} from records where ts >= timestamp '{current_from}'),
new as (select * from current c where not exists (
    select 1 from known k where k.id_1 = c.id_1 and k.id_2 = c.id_2
      and k.vaccine_group = c.vaccine_group
      and k.vaccination_date = c.vaccination_date))"""


# A record as the import file writes it; no value of the view needs quotes.
LINE_SQL = (
    "id_1 || ',' || id_2 || ',' || vaccine_group || ',' "
    "|| strftime(vaccination_date, '%m/%d/%Y')"
)
DIGEST_SQL = f"cast(concat('0x', substr(sha256({LINE_SQL}), 1, 15)) as bigint)"

# --- runs --------------------------------------------------------------------

RUN_TERMINAL = ["purchase", "signup", "error"]
RUNS_SQL = """
with runs as (
  select user_id || '_' || strftime(ts, '%Y-%m-%d') as run_id, event_type as type,
         ts as "at", event_id,
         row_number() over (partition by user_id, cast(ts as date)
                            order by ts, event_id) as seq
  from events)"""


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ledger lines: a run is one user's day."""
    rows = table(spark, sf_dir, "events").select(
        F.concat_ws("_", F.col("user_id").cast("string"), F.col("ts").cast("date")).alias(
            "run_id"
        ),
        F.col("event_type").alias("type"),
        F.col("ts").alias("at"),
        "event_id",
    )
    return sequence(rows, ["run_id"], ["at", "event_id"])


# --- delivered files ---------------------------------------------------------

ACKS_SQL = """
with acks as (
  select strftime(ts, '%Y-%m-%d') || '_' || user_id || '.csv' as file_name,
         event_type = 'purchase' as delivered, event_type = 'signup' as confirmed
  from events where event_type in ('purchase', 'signup')),
present as (
  select distinct strftime(ts, '%Y-%m-%d') || '_' || user_id || '.csv' as file_name
  from events where event_type = 'view')"""


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    name = F.concat(day, F.lit("_"), F.col("user_id").cast("string"), F.lit(".csv"))
    return table(spark, sf_dir, "events").select(name.alias("file_name"), "event_type")


def file_acks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases as deliveries, signups as confirmations, one file per user's day."""
    kind = F.col("event_type")
    return (
        file_names(spark, sf_dir)
        .filter(kind.isin("purchase", "signup"))
        .select(
            "file_name",
            (kind == "purchase").alias("delivered"),
            (kind == "signup").alias("confirmed"),
        )
    )


def files_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views as files that still lie in the folder."""
    names = file_names(spark, sf_dir).filter(F.col("event_type") == "view")
    return names.select("file_name")
