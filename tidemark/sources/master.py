"""The known set: an append-only, bucketed table of content-named segments.

A commit writes only the new records, as one segment named by their
fingerprint, then a ledger event names the version.  Readers see the segments
the ledger has committed and nothing else, so a half-written one is never
read and a repeated commit changes nothing.  All segments share one bucketing
on the record key: a diff reads the master in place, without a shuffle or sort.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.digest import fingerprint
from tidemark.operators.runs import claim_winners
from tidemark.schema import KEY, RECORD_SCHEMA
from tidemark.sources import ledger


class MasterError(RuntimeError):
    """The ledger names a master that cannot be found."""


@dataclass(frozen=True)
class Version:
    """A committed state of the master: what the ledger says of it."""

    records: int = 0
    digest: int = 0
    segments: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return f"{self.records}-{self.digest}"

    def plus(self, segment: str, records: int, digest: int) -> "Version":
        if segment in self.segments:
            return self
        return Version(
            self.records + records, self.digest + digest, (*self.segments, segment)
        )


def describe(records: DataFrame) -> tuple[str, int, int]:
    """A set's content name, size and digest."""
    row = fingerprint(records).first()
    count, digest = row["records"], int(row["fingerprint"])
    return f"{count}-{digest}", count, digest


@dataclass(frozen=True)
class Master:
    spark: SparkSession
    path: str

    # -- layout

    def buckets(self) -> int:
        """Buckets of the table, chosen once when it is made."""
        try:
            row = self.spark.read.schema("buckets int").json(f"{self.path}/layout").first()
        except AnalysisException as error:
            if not ledger.is_missing(error):
                raise
            row = None
        return row["buckets"] if row else 0

    def create(self, buckets: int | None = None) -> int:
        """Make the layout if there is none; an existing one wins."""
        have = self.buckets()
        if have:
            return have
        count = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        made = self.spark.range(1).select(F.lit(count).alias("buckets"))
        made.coalesce(1).write.mode("ignore").json(f"{self.path}/layout")
        return count

    def _table(self, buckets: int) -> str:
        name = "tidemark_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        columns = ", ".join(f.name + " " + f.dataType.simpleString() for f in RECORD_SCHEMA)
        location = f"{self.path}/segments".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, segment string) USING parquet "
            f"PARTITIONED BY (segment) CLUSTERED BY ({', '.join(KEY)}) "
            f"INTO {buckets} BUCKETS LOCATION '{location}'"
        )
        return name

    # -- reading

    def read(self, version: Version) -> DataFrame:
        """The records of a version; the empty version is the empty set."""
        if not version.segments:
            empty = F.lit(None)
            columns = [empty.cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA]
            return self.spark.range(0).select(*columns)
        buckets = self.buckets()
        if not buckets:
            raise MasterError("the ledger names a master version but there is no master")
        name = self._table(buckets)
        self.spark.sql(f"MSCK REPAIR TABLE {name}")
        present = {row[0] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()}
        missing = {f"segment={segment}" for segment in version.segments} - present
        if missing:
            raise MasterError(f"{len(missing)} committed segment(s) are missing")
        table = self.spark.table(name)
        return table.filter(F.col("segment").isin(*version.segments)).select(*KEY)

    # -- writing

    def write_segment(self, records: DataFrame, segment: str) -> None:
        """Write a set of new records as a segment, replacing a torn one.

        The segment's name is its content, so writing it again gives the same.
        """
        buckets = self.create()
        name = self._table(buckets)
        view = f"{name}_new"
        records.select(*KEY).repartition(buckets, *KEY).createOrReplaceTempView(view)
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION (segment = '{segment}') "
            f"SELECT {', '.join(KEY)} FROM {view}"
        )
        self.spark.catalog.dropTempView(view)


def commit_event(base: Version, after: Version, segment: str) -> tuple[str, dict]:
    """The event that makes ``segment`` part of the master, on top of ``base``."""
    data = {
        "base": base.name,
        "master_hash": after.name,
        "record_count": after.records,
        "snapshot_path": segment,
    }
    return "MasterCommitted", data


def committed(events: DataFrame, base: Version = Version()) -> Version:
    """The version that the ledger's commits lead to, from ``base`` on.

    Each commit names the version it was made on.  Of several commits on one
    version the first counts, ties by run id; what the others held is new again
    in the next run, so two writers never put a record in twice.  A segment whose
    name is the master's own holds the whole master, so a compaction takes the
    place of all segments before it.  One small row per commit.
    """
    attempts = events.filter(F.col("type") == "MasterCommitted").select(
        F.col("data")["base"].alias("base"),
        F.col("data")["master_hash"].alias("master"),
        "at",
        F.concat_ws(
            "\n", "run_id", F.col("data")["record_count"], F.col("data")["snapshot_path"]
        ).alias("run_id"),
    )
    moves = claim_winners(attempts.filter("base <> master"), ["base", "master"])
    moves = claim_winners(
        moves.withColumn("run_id", F.concat_ws("\n", "run_id", "master")), ["base"]
    )
    won = {row["base"]: row["run_id"] for row in moves.collect()}
    # Compactions: one segment in the place of all of a version.
    folds = attempts.filter("base = master").filter(F.col("run_id").endswith(F.concat(F.lit("\n"), "master")))
    folded = {row["base"] for row in folds.select("base").distinct().collect()}
    version = base
    if version.name in folded:
        version = Version(version.records, version.digest, (version.name,))
    while version.name in won:
        _, records, segment, master = won.pop(version.name).split("\n")
        before = () if segment == master else version.segments
        version = Version(int(records), int(master.split("-")[1]), (*before, segment))
        if version.name in folded:
            version = Version(version.records, version.digest, (version.name,))
    return version
