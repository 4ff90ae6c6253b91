"""Ratios. Division is `try_divide` throughout: a zero denominator gives NULL, not an error."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def percent_of(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * F.lit(100.0)


def defect_rate(defects: Column, inspected: Column) -> Column:
    return F.round(percent_of(defects, inspected), 2)


def availability_pct(downtime_minutes: Column, shift_minutes: float = 480.0) -> Column:
    """Share of one shift not lost; not clamped, so long histories fall below zero."""
    shift = F.lit(float(shift_minutes))
    return F.round(percent_of(shift - downtime_minutes, shift), 2)


def pct_change(current: Column, previous: Column) -> Column:
    return percent_of(current - previous, previous)


def is_high_defect(rate: Column, threshold_pct: float = 5.0) -> Column:
    """Strictly above the threshold; an unknown rate is not high."""
    return F.coalesce(rate > F.lit(float(threshold_pct)), F.lit(False))
