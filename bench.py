"""Time the headline queries; prints one JSON line.

Every query is run to its end into a sink that keeps nothing, so what is timed
is Spark's work and not the transfer of rows to Python.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark import catalog  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", int(CPUS) if CPUS.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    named = sys.argv[1:] or list(queries)
    warm = queries["new_records_per_source"]
    warm(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in named:
        start = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_wall_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
