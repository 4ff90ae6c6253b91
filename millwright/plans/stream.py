"""Deliveries as a stream: files are worked off as they arrive, in any order.

`follow` lands new files of every dataset and brings metrics and indicators up to
date. A batch that is repeated after a failure adds nothing, since landing holds
it against what is there, so every row counts once.

`live_downtime` is the stateful view of the same logs: minutes per machine and
day as they come, copies dropped, with a watermark that closes a day. What
arrives behind the watermark is late and changes no closed day; `follow` still
lands it, and the day is computed anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import StructType

from millwright.operators.metrics import minutes_by_type
from millwright.plans import daily
from millwright.plans.daily import Store
from millwright.plans.silver import downtime_events
from millwright.schemas import RAW
from millwright.workspace import concurrently

_BATCH = "_batch"


def incoming(spark: SparkSession, folder: str, schema: StructType, *, files_per_batch: int | None = None) -> DataFrame:
    """CSV files with a header row as a stream; a value that does not parse stops it."""
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).csv(folder)


def follow(
    spark: SparkSession, store: Store, checkpoint: str, products: DataFrame | None = None, *,
    datasets: Mapping[str, StructType] = RAW, as_of: datetime | None = None, files_per_batch: int | None = None,
) -> dict[str, list]:
    """Land all files below `<raw>/<dataset>` that have come since the last call, then refresh what they touch.

    Returns the recomputed periods by metric table, as `daily.refresh` does.
    """
    def land(name: str, batch: DataFrame, _: int) -> None:
        daily.land(batch.sparkSession, store, {name: batch}, as_of)

    def run(name: str) -> None:
        files = incoming(spark, f"{store.params.raw_path}/{name}", datasets[name], files_per_batch=files_per_batch)
        query = (
            files.writeStream.foreachBatch(partial(land, name)).trigger(availableNow=True)
            .option("checkpointLocation", f"{checkpoint}/{name}").start()
        )
        query.awaitTermination()

    concurrently(spark, [partial(run, name) for name in datasets])
    return daily.refresh(spark, store, products)


def live_downtime(logs: DataFrame, time: str = "timestamp", late: str = "24 hours") -> DataFrame:
    """Minutes by downtime type per machine, line, shift and day of a stream of machine logs.

    A row that comes twice within the watermark counts once. Rows without a time belong to no day.
    """
    once = logs.withWatermark(time, late).dropDuplicatesWithinWatermark()
    days = F.window(time, "1 day").alias("day")
    events = downtime_events(once).withColumn("record_date", F.to_date(time))
    return minutes_by_type(events, "machine_id", "production_line", "shift_id", "record_date", days).drop("day")


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Work off what has come; every batch adds the groups it changed, with its number."""
    def add(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{_BATCH}={number}")  # a repeated batch replaces its own rows

    query = stream.writeStream.outputMode("update").foreachBatch(add).trigger(availableNow=True)
    query.option("checkpointLocation", checkpoint).start().awaitTermination()


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last state of every group."""
    updates = spark.read.parquet(path)
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.col(_BATCH).desc()))
    return updates.withColumn("_n", newest).where(F.col("_n") == 1).drop("_n", _BATCH)
