"""Aggregations behind the metric tables and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millwright.functions import boundary_minutes, percent_of, week_start
from millwright.operators.joins import HOT_KEY_ROWS, WEIGHT, not_broadcast, weights_by_key

# The event types that count as downtime, and their columns.
DOWNTIME_COLUMNS = {
    "planned_maintenance": "planned_maint_mins",
    "unplanned_breakdown": "unplanned_breakdown_mins",
    "changeover": "changeover_mins",
    "idle": "idle_mins",
}


def minutes_by_type(events: DataFrame, *keys: str) -> DataFrame:
    """Minutes per key, one column per downtime type, and in total.

    Events of another type add 0 to a column; an unknown duration adds nothing,
    so a sum over unknown durations only is NULL.
    """
    minutes = F.col("duration_minutes")
    per_type = [
        F.sum(F.when(F.col("event_type") == kind, minutes).otherwise(F.lit(0))).alias(name)
        for kind, name in DOWNTIME_COLUMNS.items()
    ]
    return events.groupBy(*keys).agg(*per_type, F.sum(minutes).alias("total_downtime_mins"))


def defects_by_category(
    quality: DataFrame, production: DataFrame, products: DataFrame, *, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """Daily defects and inspected units per line, shift and product category.

    Same sums as over the row-level joins, but the batch's products enter as
    counted combinations, and the metrics are summed per product before the
    product table is joined: the second join sees line x shift x day x product
    rows instead of one per batch, also for batches without a product.
    """
    products_of_batch = weights_by_key(
        production, "batch_id", "batch_id", "product_id", hot_key_rows=hot_key_rows
    )
    copies = F.coalesce(F.col(WEIGHT), F.lit(1))
    per_product = (
        quality.select(
            "batch_id", "production_line", "shift_id", "production_date",
            "defect_count", "total_inspected",
        )
        .join(not_broadcast(products_of_batch), "batch_id", "left")
        .groupBy("production_line", "shift_id", "production_date", "product_id")
        .agg(
            F.sum(F.col("defect_count") * copies).alias("defects"),
            F.sum(F.col("total_inspected") * copies).alias("units"),
        )
    )
    total, units = F.col("total_defects"), F.col("total_units")
    return (
        per_product.join(not_broadcast(products.select("product_id", "product_category")), "product_id", "left")
        .groupBy("production_line", "shift_id", "product_category", "production_date")
        .agg(F.sum("defects").alias("total_defects"), F.sum("units").alias("total_units"))
        .select(
            "production_line",
            "shift_id",
            "product_category",
            week_start(F.col("production_date")).alias("prod_week"),
            "production_date",
            "total_defects",
            "total_units",
            F.when(units == 0, F.lit(0.0)).otherwise(percent_of(total, units)).alias("daily_defect_rate"),
        )
    )


def units_per_hour(production: DataFrame) -> DataFrame:
    """Units, hours and their ratio per line, shift and day; 0 without positive hours."""
    hours = F.col("prod_hours")
    return (
        production.groupBy("production_line", "shift_id", "production_date")
        .agg(
            F.sum("units_produced").alias("total_units"),
            (F.sum(boundary_minutes(F.col("start_time"), F.col("end_time"))) / F.lit(60.0)).alias("prod_hours"),
        )
        .withColumn(
            "units_per_hour",
            F.when(hours > 0, F.try_divide(F.col("total_units"), hours)).otherwise(F.lit(0.0)),
        )
    )
