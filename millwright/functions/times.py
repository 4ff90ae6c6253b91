"""Time arithmetic."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F


def delay_hours(event: Column, reference: Column) -> Column:
    """Signed hours from `reference` to `event`, to the microsecond."""
    micros = F.unix_micros(event.cast("timestamp")) - F.unix_micros(reference.cast("timestamp"))
    return micros / F.lit(3.6e9)


def deadline(reference: Column, max_hours: float) -> Column:
    """`reference` plus a number of hours.

    Comparing an event with this keeps the event column bare, so a constant
    reference folds into a literal that the Parquet scan can use.
    """
    zero = F.lit(0)
    seconds = F.lit(Decimal(str(max_hours)) * 3600).cast("decimal(18,6)")
    return reference + F.make_dt_interval(zero, zero, zero, seconds)


def boundary_minutes(start: Column, end: Column) -> Column:
    """Minute boundaries crossed: 10:00:59 to 10:01:01 is 1."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", start), F.date_trunc("minute", end))


def week_start(day: Column) -> Column:
    """Monday of the week, as a DATE."""
    return F.trunc(day, "week")
