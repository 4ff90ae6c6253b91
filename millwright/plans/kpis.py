"""The four indicators over the serving tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from millwright.functions import is_high_defect, pct_change
from millwright.operators.frames import GROUP_ROWS, over_preceding, with_rank
from millwright.operators.joins import HOT_KEY_ROWS, material_with_quality
from millwright.operators.ranges import RANGE, in_ranges
from millwright.operators.metrics import defects_by_category, units_per_hour
from millwright.workspace import stage_counted

INDICATORS = ("kpi_defect_rate", "kpi_throughput", "kpi_downtime", "kpi_material_batch_trends")

_CELL = ("production_line", "shift_id", "product_category")

# How the indicators are shown: leading keys and whether they descend. The keys
# behind them settle ties, which also lets the sort split one day or one
# supplier's day over several tasks.
DISPLAY: dict[str, list[tuple[str, bool]]] = {
    "kpi_defect_rate": [("production_date", True), *[(c, False) for c in _CELL]],
    "kpi_material_batch_trends": [
        ("supplier_id", False), ("received_date", True),
        ("batch_id", False), ("material_id", False), ("defect_rate", False),
    ],
}


# Indicators of a row per calendar day and cell: far cheaper to store once more than to
# compute twice, as a write in display order does with the last stage of its input.
SMALL = ("kpi_defect_rate",)


def display_order(name: str) -> list[Column]:
    """What the named indicator is sorted by where it is shown, NULLs last; nothing if its order does not matter."""
    return [F.expr(c).desc_nulls_last() if down else F.expr(c).asc_nulls_last() for c, down in DISPLAY.get(name, [])]


def in_display_order(df: DataFrame, name: str) -> DataFrame:
    """Sorted as the named indicator is shown.

    Pass a stored table: a global sort reads its input twice.
    """
    keys = display_order(name)
    return df.orderBy(*keys) if keys else df


def kpi_defect_rate(
    quality: DataFrame,
    production: DataFrame,
    products: DataFrame,
    *,
    window_rows: int = 7,
    calendar_days: int | None = None,
    hot_key_rows: int = HOT_KEY_ROWS,
) -> DataFrame:
    """Daily defect rate per line, shift and category with its rolling mean.

    The mean is over the last `window_rows` days that have data, or over the
    last `calendar_days` days of the calendar. A window group holds one row per
    day, so the calendar bounds it and an ordinary window is safe.
    """
    daily = defects_by_category(quality, production, products, hot_key_rows=hot_key_rows)
    if calendar_days is None:
        frame = (
            Window.partitionBy(*_CELL)
            .orderBy(F.col("production_date").asc_nulls_last())
            .rowsBetween(1 - window_rows, Window.currentRow)
        )
    else:
        frame = (
            Window.partitionBy(*_CELL)
            .orderBy(F.unix_date("production_date").asc_nulls_last())
            .rangeBetween(1 - calendar_days, Window.currentRow)
        )
    return daily.withColumn("rolling_7d_defect_rate", F.avg("daily_defect_rate").over(frame))


def kpi_throughput(production: DataFrame, *, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Units per hour, the line's previous shift, the change, and the rank of the day."""
    hourly, rows = stage_counted(
        units_per_hour(production).select(
            "production_line", "shift_id", "production_date", "units_per_hour"
        )
    )
    with_previous = over_preceding(
        hourly,
        ["production_line"],
        ["production_date", "shift_id"],
        1,
        {"prev_shift_uph": lambda window: F.lag("units_per_hour", 1).over(window)},
        group_rows=group_rows,
        rows=rows,
    ).withColumn("pct_change_vs_prev", pct_change(F.col("units_per_hour"), F.col("prev_shift_uph")))
    return with_rank(
        with_previous,
        ["production_date"],
        "units_per_hour",
        "throughput_rank",
        group_rows=group_rows,
        rows=rows,
    )


def kpi_downtime(
    downtime: DataFrame,
    *,
    as_of: date | None = None,
    window_rows: int = 30,
    group_rows: int = GROUP_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Downtime rows with a record date and a running total per machine.

    `downtime` should be a stored or staged table, with its number of `rows` if
    known. Without a day in its grain
    every row gets the same date, and line and shift settle the order.
    """
    if "record_date" not in downtime.columns:
        downtime = downtime.withColumn("record_date", F.current_date() if as_of is None else F.lit(as_of))
    minutes = "total_downtime_mins"
    return over_preceding(
        downtime,
        ["machine_id"],
        ["record_date", "production_line", "shift_id"],
        window_rows - 1,
        {
            "cumulative_30d_downtime_mins": lambda window: F.sum(minutes).over(
                window.rowsBetween(1 - window_rows, Window.currentRow)
            )
        },
        group_rows=group_rows,
        rows=rows,
    ).select(
        "machine_id", "production_line", "shift_id", "record_date", "planned_maint_mins",
        "unplanned_breakdown_mins", "changeover_mins", "idle_mins", minutes,
        F.col("machine_availability_pct").cast("double").alias("machine_availability_pct"),
        "cumulative_30d_downtime_mins",
    )


def _most(df: DataFrame, key: str) -> int:
    """Rows of the most frequent value."""
    return df.groupBy(key).count().agg(F.max("count")).first()[0] or 0


def kpi_material_batch(
    materials: DataFrame,
    quality: DataFrame,
    *,
    high_defect_pct: float = 5.0,
    window_rows: int = 4,
    group_rows: int = GROUP_ROWS,
    hot_key_rows: int = HOT_KEY_ROWS,
    ranges: int | None = None,
) -> DataFrame:
    """Material rows with their batch's defect rate and the supplier's recent mean.

    Pass stored tables. No supplier has more rows than its materials times the most
    metric rows of a batch; only if that leaves open whether a window group fits
    a task, the joined rows are stored to be measured. Where every group fits and
    `ranges` is given, the one shuffle behind the join deals the suppliers into that
    many ranges, whose number stays in the column `RANGE` for a write in display order.
    """
    joined = material_with_quality(materials, quality, hot_key_rows=hot_key_rows)
    rows = _most(materials, "supplier_id") * _most(quality, "batch_id")
    group = ["supplier_id"]
    if rows > group_rows:
        joined, rows = stage_counted(joined)
    elif ranges:
        joined, group = in_ranges(joined, "supplier_id", ranges, materials), ["supplier_id", RANGE]
    return over_preceding(
        joined.withColumn("is_high_defect_batch", is_high_defect(F.col("defect_rate"), high_defect_pct)),
        group,
        ["received_date", "batch_id", "material_id", "defect_rate"],
        window_rows,
        {
            "historical_avg_defect_rate_last_4": lambda window: F.avg("defect_rate").over(
                window.rowsBetween(-window_rows, -1)
            )
        },
        group_rows=group_rows,
        rows=rows,
    )
