"""Rows dealt into ranges of one column, so that a window and a write in order share one shuffle."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

RANGE = "_range"

# Values to see per range when the bounds are sampled.
SAMPLE_PER_RANGE = 100


def _place(value: Column, bounds: list[Any], first: int, last: int) -> Column:
    """How many of the rising bounds are not above the value, by bisection; NULL lies behind all."""
    if first == last:
        return F.lit(first)
    middle = (first + last) // 2
    below = value < F.lit(bounds[middle])
    return F.when(below, _place(value, bounds, first, middle)).otherwise(_place(value, bounds, middle + 1, last))


def in_ranges(df: DataFrame, key: str, ranges: int, sampled: DataFrame) -> DataFrame:
    """`df` in `ranges` partitions that follow each other by `key`, NULLs last, with their number in `RANGE`.

    A key lies in one range only. The bounds come from a sample of the column in
    `sampled`, a stored table with about the same keys, so `df` itself is run once,
    which a `repartitionByRange` runs twice. They steer where rows go, never which there are.
    """
    keys = sampled.select(key).where(F.col(key).isNotNull())
    fraction = min(1.0, ranges * SAMPLE_PER_RANGE / max(1, sampled.count()))
    seen = [row[0] for row in keys.sample(fraction, seed=1).orderBy(key).collect()]  # SAMPLE_PER_RANGE a range
    bounds = list(dict.fromkeys(seen[i * len(seen) // ranges] for i in range(1, ranges))) if seen else []
    placed = df.withColumn(RANGE, _place(F.col(key), bounds, 0, len(bounds)))
    return placed.repartitionById(ranges, F.col(RANGE))
