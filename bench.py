"""Time the headline queries: one warm-up, then the median of three runs.

Reads $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import QUERIES  # noqa: E402
from millwright.workspace import open_session  # noqa: E402

HEADLINE = [
    "bronze_ingest", "silver_quality", "silver_quality_end_time", "silver_downtime", "kpi_defect_rate",
    "kpi_throughput", "kpi_downtime", "kpi_material_batch", "dq_report", "publish_quality",
]
RUNS = 3


def timed(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    spark = open_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        timed(spark, folder, name)
        seconds[name] = round(statistics.median(timed(spark, folder, name) for _ in range(RUNS)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()
