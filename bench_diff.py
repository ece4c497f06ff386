"""Time and shuffle bytes of each shape of the diff, and rows/s of the export.

The master is the shipment view in ``COPIES`` renamed copies, bucketed; the
batch is a small or a large share of one more copy plus known records.  Bytes
come from the session's event log, written to a new scratch folder.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.catalog import views  # noqa: E402
from tidemark.operators import records  # noqa: E402
from tidemark.plans.store import Store  # noqa: E402
from tidemark.schema import KEY  # noqa: E402
from tidemark.session import build_session, scratch_path, stage  # noqa: E402
from tidemark.sinks import export  # noqa: E402
from tidemark.sources.master import describe  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
COPIES = int(os.environ.get("BENCH_COPIES", "20"))


def shuffle_bytes(folder: str) -> dict[str, int]:
    """Shuffle bytes written per job group."""
    group_of, written = {}, defaultdict(int)
    for path in glob.glob(f"{folder}/*"):
        for text in open(path):
            event = json.loads(text)
            if event["Event"] == "SparkListenerJobStart":
                group = event.get("Properties", {}).get("spark.jobGroup.id")
                for number in event["Stage IDs"]:
                    group_of.setdefault(number, group)
            elif event["Event"] == "SparkListenerTaskEnd":
                metrics = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                written[group_of.get(event["Stage ID"])] += metrics.get(
                    "Shuffle Bytes Written", 0
                )
    return written


def main() -> None:
    log = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = build_session(
        "bench-diff",
        f"local[{CPUS}]",
        CPUS,
        **{
            "spark.driver.memory": "16g",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    base = views.shipments(spark, SF_DIR).select(*KEY)
    renamed = F.concat_ws("-", "id_1", F.col("copy").cast("string"))
    whole = records.dedupe(
        base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        .withColumn("id_1", renamed)
    )
    master = stage(whole, "master")
    store = Store(spark, scratch_path(spark, "store"))
    segment, count, digest = describe(master)
    store.master.write_segment(master, segment)
    bucketed = store.master.read(store.version().plus(segment, count, digest))

    fresh = records.dedupe(base).withColumn("id_1", F.concat_ws("-", "id_1", F.lit("new")))
    batches = {
        "small": stage(fresh.limit(4_000).unionByName(master.limit(4_000)), "small"),
        "large": stage(fresh.unionByName(master.limit(600_000)), "large"),
    }
    shapes = {
        "anti_join": (records.diff, master),
        "semi_then_anti_broadcast": (records.diff_broadcast, master),
        "semi_then_anti_hashed_bucketed": (records.diff_hashed, bucketed),
        "anti_join_bucketed": (records.diff, bucketed),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    results = []
    for size, batch in batches.items():
        measured = records.measure(batch)
        for name, (shape, known) in shapes.items():
            if "broadcast" in name and not measured.fits(records.BROADCAST_BYTES):
                continue
            best, found = None, None
            for attempt in range(3):
                group = f"{size}/{name}/{attempt}"
                spark.sparkContext.setJobGroup(group, group)
                start = time.perf_counter()
                found = shape(batch, known).count()
                took = time.perf_counter() - start
                best = min(best or took, took)
            results.append([size, name, measured.rows, found, round(best, 2), group])
    spark.sparkContext.setJobGroup("export", "export")
    for rows in (1_000, 10_000):
        start = time.perf_counter()
        numbered = export.write_chunks(
            stage(records.dedupe(base), "export"),
            scratch_path(spark, "chunks"),
            dt.date(2024, 1, 31),
            rows,
        )
        took = time.perf_counter() - start
        results.append(["export", f"chunks of {rows}", numbered.total, "", round(took, 2), None])
    spark.stop()
    written = shuffle_bytes(log)
    print(json.dumps({"master_records": count, "sf": os.path.basename(SF_DIR)}))
    for size, name, rows, found, took, group in results:
        line = {"batch": size, "shape": name, "rows": rows, "new": found, "seconds": took}
        if group:
            line["shuffle_mb"] = round(written[group] / 1e6, 2)
        else:
            line["rows_per_second"] = round(rows / took)
        print(json.dumps(line))


if __name__ == "__main__":
    main()
