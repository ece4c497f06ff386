"""Whole jobs over landings written from the tables, batch and streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark.catalog import views
from tidemark.catalog.files import _glob, _write_extracts
from tidemark.catalog.views import DIGEST_SQL, KEYS, RECORDS_SQL
from tidemark.functions.digest import fingerprint
from tidemark.operators import records
from tidemark.plans import jobs
from tidemark.plans.store import Store
from tidemark.schema import KEY
from tidemark.session import scratch_path, stage
from tidemark.sources import extracts
from tidemark.sources.extracts import IMPORT, REGISTRY
from tidemark.sources.master import commit_event, describe
from tidemark.streaming.first_seen import first_seen_stream
from tidemark.streaming.landing import stream_landing


# Events of all sources that one part of a job's landing covers: files of a few
# megabytes, as each file costs an entry in listings, a folder and a commit.
PART_RECORDS = 500_000


def _land(spark, sf_dir, rows):
    return _write_extracts(spark, sf_dir, rows, part_records=PART_RECORDS)


def _two_runs(spark, sf_dir):
    """What was known is delivered first; then what came in."""
    store = Store(spark, scratch_path(spark, "store"))
    rows = views.records(spark, sf_dir)
    known = _land(spark, sf_dir, views.before(rows, views.KNOWN_UNTIL))
    current = _land(spark, sf_dir, views.since(rows, views.CURRENT_FROM))
    first = dt.date(2024, 1, 21)
    jobs.run_incremental(store, _glob(known), REGISTRY, first, fraction=None)
    second = jobs.run_incremental(
        store, _glob(current), REGISTRY, views.AS_OF, fraction=None
    )
    return store, second, current


def incremental_run(spark, sf_dir):
    """The diff file the second run delivered, read back."""
    _, second, _ = _two_runs(spark, sf_dir)
    landing = extracts.read_landing(spark, [f"{second.delivered_path}/part-*"], IMPORT)
    return extracts.combine(landing)


def incremental_replay(spark, sf_dir):
    """The master after both runs and a replay of the second."""
    store, _, current = _two_runs(spark, sf_dir)
    jobs.run_incremental(store, _glob(current), REGISTRY, views.AS_OF, fraction=None)
    return store.known()


def gate_blocks_run(spark, sf_dir):
    """A diff far larger than history: the run fails, the master stays."""
    store = Store(spark, scratch_path(spark, "store"))
    rows = views.records(spark, sf_dir)
    known = _land(spark, sf_dir, views.before(rows, "2024-01-08"))
    flood = _land(spark, sf_dir, views.since(rows, "2024-01-05"))
    jobs.run_incremental(store, _glob(known), REGISTRY, dt.date(2024, 1, 8))
    jobs.run_incremental(store, _glob(flood), REGISTRY, views.AS_OF)
    return store.known()


def blocked_archive(spark, sf_dir):
    """What the gate stopped is archived all the same."""
    store = Store(spark, scratch_path(spark, "store"))
    rows = views.records(spark, sf_dir)
    known = _land(spark, sf_dir, views.before(rows, "2024-01-08"))
    flood = _land(spark, sf_dir, views.since(rows, "2024-01-05"))
    jobs.run_incremental(store, _glob(known), REGISTRY, dt.date(2024, 1, 8))
    done = jobs.run_incremental(store, _glob(flood), REGISTRY, views.AS_OF)
    archived = spark.read.parquet(f"{store.archive_path}/date={views.AS_OF.isoformat()}/*")
    return archived.select(*KEY, F.lit(done.status).alias("status"))


def master_commit_replay(spark, sf_dir):
    """Segments committed twice: the same records, the same fingerprint."""
    known, current = views.known_and_current(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "store"))
    known = stage(known, "known")
    new = stage(records.diff(current, known), "new")
    version = store.version()
    for part in [known, new, new]:
        segment, count, digest = describe(part)
        store.master.write_segment(part, segment)
        after = version.plus(segment, count, digest)
        made = commit_event(version, after, segment)
        store.run_ledger("commit").append(made, required=True)
        version = after
    read = fingerprint(store.known())
    return read.withColumn("fingerprint", F.col("fingerprint").cast("string"))


def rival_commits(spark, sf_dir):
    """Two writers commit overlapping sets on one version; the loser comes again.

    The union is in the master once, by the records read and by their count."""
    known, current = views.known_and_current(spark, sf_dir)
    store = Store(spark, scratch_path(spark, "store"))
    base = store.version()
    for run, part in (("first", known), ("second", current)):
        part = stage(part, run)
        segment, count, digest = describe(part)
        store.master.write_segment(part, segment)
        made = commit_event(base, base.plus(segment, count, digest), segment)
        store.run_ledger(run).append(made, required=True)
    landing = _land(spark, sf_dir, views.since(views.records(spark, sf_dir), views.CURRENT_FROM))
    jobs.run_incremental(store, _glob(landing), REGISTRY, views.AS_OF, fraction=None)
    return store.known()


def _remove(spark, path):
    """Deletes a folder wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def reconciliation_job(spark, sf_dir):
    """Three diffs of one day, the first imported since; a backfill's day asks.

    Each delivery's records and status."""
    store = Store(spark, scratch_path(spark, "store"))
    rows = views.records(spark, sf_dir)
    paths = []
    for until in ("2024-01-10", "2024-01-20", "2024-02-01"):
        landing = _land(spark, sf_dir, views.before(rows, until))
        done = jobs.run_incremental(store, _glob(landing), REGISTRY, views.AS_OF, fraction=None)
        paths.append(done.delivered_path)
    _remove(spark, paths[0])
    status = jobs.run_reconciliation(store, dt.date(2024, 3, 31))
    records_of = F.substring_index("remote_id", "-", 1).cast("long")
    return status.select(records_of.alias("records"), "status")


def stream_blocked_then_released(spark, sf_dir):
    """A landing the gate stops is taken whole once the gate is off."""
    store = Store(spark, scratch_path(spark, "store"))
    rows = views.records(spark, sf_dir)
    checkpoint = scratch_path(spark, "stream")
    landing = scratch_path(spark, "landing")
    for number, (part, fraction) in enumerate(
        [(views.before(rows, "2024-01-04"), 0.2), (rows, 0.2), (None, None)]
    ):
        if part is not None:
            part.select(
                "id_1", "id_2", F.col("vaccine_group").alias("vaccine_group_name"), "vaccination_date"
            ).write.option("header", "true").option("sep", "|").csv(f"{landing}/day={number}")
        query = stream_landing(
            store, f"{landing}/*", checkpoint, REGISTRY, views.AS_OF, fraction=fraction
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if fraction is None:
                raise
    return store.known()


def rebaseline_export(spark, sf_dir):
    """The whole master exported in chunk files and read back."""
    store, _, _ = _two_runs(spark, sf_dir)
    done = jobs.run_rebaseline(store, views.AS_OF, size=1000)
    landing = extracts.read_landing(spark, [f"{done.delivered_path}/*/part-*"], IMPORT)
    return extracts.combine(landing)


def compacted_master(spark, sf_dir):
    """The master after its segments were folded into one."""
    store, _, _ = _two_runs(spark, sf_dir)
    jobs.compact(store)
    return store.known()


def stream_incremental_diff(spark, sf_dir):
    """Two landings taken by the stream, the second overlapping the first."""
    store = Store(spark, scratch_path(spark, "store"))
    checkpoint = scratch_path(spark, "stream")
    landing = scratch_path(spark, "landing")
    rows = views.records(spark, sf_dir)
    part = F.floor(F.col("event_id") / F.lit(PART_RECORDS))
    halves = [views.before(rows, views.KNOWN_UNTIL), views.since(rows, views.CURRENT_FROM)]
    for number, half in enumerate(halves):
        (
            half.withColumn("source", F.col("id_2"))
            .withColumn("part", part)
            .repartition("source", "part")
            .select(
                "source",
                "part",
                "id_1",
                "id_2",
                F.col("vaccine_group").alias("vaccine_group_name"),
                "vaccination_date",
            )
            .write.partitionBy("source", "part")
            .option("header", "true")
            .option("sep", "|")
            .csv(f"{landing}/day={number}")
        )
        stream_landing(
            store, f"{landing}/*/*/*", checkpoint, REGISTRY, views.AS_OF, fraction=None
        ).awaitTermination()
    return store.known()


class _Lost(RuntimeError):
    """What a run dies of in :class:`_Dying`."""


class _Dying(Store):
    """A store whose master is lost between delivery and commit."""

    @property
    def master(self):
        class Lost(type(super().master)):
            def write_segment(self, records, segment):
                raise _Lost

        return Lost(self.spark, f"{self.root}/master")


def stream_late_sources(spark, sf_dir):
    """Files out of order: newer days first, then older ones, a source that comes last.

    The run over the older days dies after its delivery; the stream is started
    again when the late source has come, too.  Each record with the number of
    files it was delivered in, and whether the master holds it.
    """
    store = Store(spark, scratch_path(spark, "store"))
    checkpoint, landing = scratch_path(spark, "stream"), scratch_path(spark, "landing")
    rows = views.records(spark, sf_dir)
    late, middle = F.col("id_2") == "S003", "2024-01-16"
    parts = [
        (views.since(rows, middle).where(~late), store, True),
        (views.before(rows, middle).where(~late), _Dying(spark, store.root), False),
        (rows.where(late), store, True),
    ]
    for number, (part, kept, lives) in enumerate(parts):
        part.select(
            "id_1", "id_2", F.col("vaccine_group").alias("vaccine_group_name"), "vaccination_date"
        ).write.option("header", "true").option("sep", "|").csv(f"{landing}/day={number}")
        query = stream_landing(
            kept, f"{landing}/*", checkpoint, REGISTRY, views.AS_OF, fraction=None
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if lives:
                raise
    sent = extracts.read_landing(spark, [f"{store.delivery_path}/*/*/*/part-*"], IMPORT).records
    return (
        sent.select(*KEY, F.lit(1).alias("sent"))
        .unionByName(store.known().select(*KEY, F.lit(0).alias("sent")))
        .groupBy(*KEY)
        .agg(F.sum("sent").alias("deliveries"), F.count_if(F.col("sent") == 0).alias("in_master"))
    )


def stream_first_seen(spark, sf_dir):
    """Distinct records of the events read as a stream."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = (
        spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parque[t]")
    )
    rows = stream.select(
        F.format_string("%05d", "user_id").alias("id_1"),
        F.format_string("S%03d", F.col("user_id") % 8).alias("id_2"),
        F.col("event_type").alias("vaccine_group"),
        F.col("ts").cast("date").alias("vaccination_date"),
        "event_id",
    )
    out = scratch_path(spark, "first-seen")
    (
        first_seen_stream(rows, "event_id")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "first-seen-state"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(out).select(*KEY)


QUERIES = {
    "incremental_run": incremental_run,
    "incremental_replay": incremental_replay,
    "gate_blocks_run": gate_blocks_run,
    "blocked_archive": blocked_archive,
    "master_commit_replay": master_commit_replay,
    "rival_commits": rival_commits,
    "reconciliation_job": reconciliation_job,
    "rebaseline_export": rebaseline_export,
    "compacted_master": compacted_master,
    "stream_incremental_diff": stream_incremental_diff,
    "stream_blocked_then_released": stream_blocked_then_released,
    "stream_late_sources": stream_late_sources,
    "stream_first_seen": stream_first_seen,
}

_SETS = views.sets_sql()
_ALL = f"{_SETS} select * from known union select * from current"

SQL = {
    "incremental_run": f"{_SETS} select {KEYS} from new",
    "incremental_replay": _ALL,
    "gate_blocks_run": f"""
select distinct {KEYS} from ({RECORDS_SQL}) where ts < timestamp '2024-01-08'""",
    "blocked_archive": f"""
select distinct {KEYS}, 'blocked' as status from ({RECORDS_SQL}) r
where ts >= timestamp '2024-01-05' and not exists (
  select 1 from ({RECORDS_SQL}) k where k.ts < timestamp '2024-01-08' and k.id_1 = r.id_1
    and k.id_2 = r.id_2 and k.vaccine_group = r.vaccine_group
    and k.vaccination_date = r.vaccination_date)""",
    "master_commit_replay": f"""{_SETS}, master as (select * from known union select * from new)
select count(*) as records, cast(sum({DIGEST_SQL}) as varchar) as fingerprint from master""",
    "rival_commits": _ALL,
    "reconciliation_job": f"""
with firsts as (
  select min(case when ts < timestamp '2024-01-10' then 1
                  when ts < timestamp '2024-01-20' then 2 else 3 end) as part
  from ({RECORDS_SQL}) where ts < timestamp '2024-02-01' group by {KEYS})
select count(*) as records, case part when 1 then 'imported' else 'overdue' end as status
from firsts group by part""",
    "rebaseline_export": _ALL,
    "compacted_master": _ALL,
    "stream_incremental_diff": _ALL,
    "stream_blocked_then_released": f"select distinct {KEYS} from ({RECORDS_SQL})",
    "stream_late_sources": f"""
select distinct {KEYS}, 1::bigint as deliveries, 1::bigint as in_master from ({RECORDS_SQL})""",
    "stream_first_seen": f"select distinct {KEYS} from ({RECORDS_SQL})",
}
