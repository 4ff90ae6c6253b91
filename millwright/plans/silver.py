"""Bronze to the two metric tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millwright.functions import availability_pct, defect_rate
from millwright.operators.joins import HOT_KEY_ROWS, WEIGHT, not_broadcast, salted_join, weights_by_key, weights_if_hot
from millwright.operators.metrics import DOWNTIME_COLUMNS, minutes_by_type
from millwright.operators.rows import drop_late, of_types
from millwright.schemas import INGESTED_AT

_GRAIN = ("production_line", "shift_id", "batch_id", "production_date")


def quality_metrics(
    inspections: DataFrame,
    production: DataFrame,
    *,
    max_late_hours: float = 24,
    late_reference: str | Column = INGESTED_AT,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Defects, inspected units and defect rate per line, shift, batch and day.

    `late_reference` is what inspection times are compared with: a column of the
    inspections, an expression over them, or a column of production such as
    `end_time`. Pass stored tables: the key columns are looked at before the join.
    """
    if isinstance(late_reference, str) and late_reference not in inspections.columns:
        summed = _by_production_time(inspections, production, late_reference, max_late_hours, hot_key_rows)
    else:
        summed = _by_inspection(inspections, production, late_reference, max_late_hours, hot_key_rows)
    return _with_rate(summed)


def _with_rate(summed: DataFrame) -> DataFrame:
    rate = defect_rate(F.col("defect_count"), F.col("total_inspected"))
    return summed.withColumn("defect_rate", rate).fillna({"defect_rate": 0.0})


def _by_inspection(
    inspections: DataFrame,
    production: DataFrame,
    reference: str | Column,
    max_hours: float,
    hot_key_rows: int,
) -> DataFrame:
    """Inspections shrink to one row per batch before they meet production.

    A batch with a third of all inspections is summed inside the scan tasks, and
    a batch with very many production rows is combined first as well, so neither
    makes a large task. The join output stays partitioned by batch, which the
    last grouping needs: one shuffle per side.
    """
    reference = F.col(reference) if isinstance(reference, str) else reference
    return _summed(inspected_per_batch(inspections, reference, max_hours, "batch_id"), production, hot_key_rows)


def inspected_per_batch(inspections: DataFrame, reference: Column, max_hours: float, *keys: str) -> DataFrame:
    """Defects (`_defects`) and units (`_inspected`) of inspections that are not late, per key."""
    return (
        drop_late(inspections, "inspection_timestamp", reference, max_hours)
        .groupBy(*keys)
        .agg(F.sum("defect_found").alias("_defects"), F.count("inspection_id").alias("_inspected"))
    )


def metrics_of_batches(per_batch: DataFrame, production: DataFrame, hot_key_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The quality metrics from inspections that have been summed per batch."""
    return _with_rate(_summed(per_batch, production, hot_key_rows))


def _summed(per_batch: DataFrame, production: DataFrame, hot_key_rows: int) -> DataFrame:
    made = weights_if_hot(production, "batch_id", *_GRAIN, hot_key_rows=hot_key_rows)
    copies = F.col(WEIGHT)
    return (
        per_batch.join(not_broadcast(made), "batch_id", "inner")
        .groupBy(*_GRAIN)
        .agg(
            F.sum(F.col("_defects") * copies).alias("defect_count"),
            F.sum(F.col("_inspected") * copies).alias("total_inspected"),
        )
    )


def _by_production_time(
    inspections: DataFrame, production: DataFrame, reference: str, max_hours: float, hot_key_rows: int
) -> DataFrame:
    """The limit depends on the batch, so single inspections meet their batch first.

    Of the inspection id only whether there is one matters, so a flag is
    shuffled in its place; its hash spreads hot batches and is pruned otherwise.
    """
    copies = F.col(WEIGHT)
    joined = salted_join(
        inspections.select(
            "batch_id", "defect_found", "inspection_timestamp",
            F.col("inspection_id").isNotNull().cast("int").alias("_inspected"),
            F.xxhash64("inspection_id", "inspection_timestamp").alias("_spread"),
        ),
        weights_by_key(production, "batch_id", *_GRAIN, reference, hot_key_rows=hot_key_rows),
        "batch_id",
        ["_spread"],
        hot_key_rows=hot_key_rows,
    )
    return (
        drop_late(joined, "inspection_timestamp", F.col(reference), max_hours)
        .groupBy(*_GRAIN)
        .agg(
            F.sum(F.col("defect_found") * copies).alias("defect_count"),
            F.sum(F.col("_inspected") * copies).alias("total_inspected"),
        )
    )


def downtime_events(machine_logs: DataFrame) -> DataFrame:
    return of_types(machine_logs, "event_type", tuple(DOWNTIME_COLUMNS))


def downtime_metrics(
    machine_logs: DataFrame, *, shift_minutes: float = 480.0, by_date: str | None = None
) -> DataFrame:
    """Downtime minutes and availability per machine, line and shift.

    Minutes of all days add up against one shift length, as the indicator
    defines it. `by_date` names a timestamp column to add the day to the grain.
    """
    events = downtime_events(machine_logs)
    keys = ["machine_id", "production_line", "shift_id"]
    if by_date:
        events = events.withColumn("record_date", F.col(by_date).cast("date"))
        keys.append("record_date")
    availability = availability_pct(F.col("total_downtime_mins"), shift_minutes)
    return minutes_by_type(events, *keys).withColumn("machine_availability_pct", availability)
