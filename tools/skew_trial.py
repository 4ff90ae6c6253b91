"""Time plans on a skewed copy of the test tables, with and without the care for hot groups.

    python tools/skew_trial.py <folder> [copies]

Repeats the order and line-item tables, moves a third of the line items to one
order and, independently, a third to one supplier, and runs each plan twice:
limits out of reach, then limits that treat the hot groups. Prints seconds, the
largest task of the slowest stage next to the median, and a checksum that must
not change.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog import Factory  # noqa: E402
from millwright.plans import kpis, silver  # noqa: E402
from millwright.workspace import open_session  # noqa: E402

NEVER = 10**12


def skewed_copy(spark: SparkSession, source: str, target: str, copies: int) -> None:
    orders = spark.read.parquet(f"{source}/orders.parquet")
    items = spark.read.parquet(f"{source}/lineitem.parquet")
    width = orders.count()
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))

    def third(seed: int):
        return F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", F.lit(seed)), F.lit(3)) == 0

    repeated = items.withColumn("copy", copy).withColumn("l_orderkey", F.col("l_orderkey") + F.col("copy") * width)
    repeated.drop("copy").withColumns({
        "l_suppkey": F.when(third(1), F.lit(0)).otherwise(F.col("l_suppkey")),
        "l_orderkey": F.when(third(2), F.lit(7)).otherwise(F.col("l_orderkey")),
    }).repartition(32).write.parquet(f"{target}/lineitem.parquet")
    orders.withColumn("copy", copy).withColumn(
        "o_orderkey", F.col("o_orderkey") + F.col("copy") * width
    ).drop("copy").repartition(16).write.parquet(f"{target}/orders.parquet")


def plans(t: Factory, hot: int) -> dict[str, Callable[[], DataFrame]]:
    return {
        "quality by end time": lambda: silver.quality_metrics(
            t.inspections, t.production, late_reference="end_time", hot_key_rows=hot
        ),
        "material batches": lambda: kpis.kpi_material_batch(
            t.materials, t.quality, group_rows=hot, hot_key_rows=hot
        ),
    }


def main() -> None:
    source, copies = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 20
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.mkdir(f"{work}/events")
    spark = open_session(
        "skew", "local[8]", spark__sql__shuffle__partitions="32", spark__driver__memory="16g",
        spark__checkpoint__dir=f"{work}/shared", spark__sql__autoBroadcastJoinThreshold="1000",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__eventLog__enabled="true", spark__eventLog__dir=f"file://{work}/events",
        spark__eventLog__compress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    skewed_copy(spark, source, work, copies)
    t = Factory(spark, work)
    limit = max(1, t.materials.count() // 12)
    timings = {}
    for label, hot in (("plain", NEVER), ("hot groups split", limit)):
        for name, build in plans(t, hot).items():
            key = f"{name}, {label}"
            spark.sparkContext.setJobDescription(key)
            started = time.perf_counter()
            df = build()
            total = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
            row = df.agg(F.count(F.lit(1)), total).first()
            timings[key] = time.perf_counter() - started, *row
    spark.stop()

    label_of, tasks = {}, {}
    for path in glob.glob(f"{work}/events/**/events_*", recursive=True):
        for line in open(path, encoding="utf-8"):
            event = json.loads(line)
            if event["Event"] == "SparkListenerJobStart":
                for stage in event["Stage IDs"]:
                    label_of[stage] = event["Properties"].get("spark.job.description")
            elif event["Event"] == "SparkListenerTaskEnd" and "Task Metrics" in event:
                tasks.setdefault(event["Stage ID"], []).append(event["Task Metrics"])
    for key, (seconds, rows, checksum) in timings.items():
        reads = [
            sorted(m["Shuffle Read Metrics"]["Total Records Read"] for m in tasks[stage])
            for stage in tasks if label_of.get(stage) == key
        ]
        widest = max(reads, key=lambda r: r[-1])
        print(
            f"{key:40s} {seconds:6.1f}s  largest task {widest[-1]:>10,} rows, "
            f"median {widest[len(widest) // 2]:>9,}  rows {rows:,}  checksum {checksum}"
        )


if __name__ == "__main__":
    main()
