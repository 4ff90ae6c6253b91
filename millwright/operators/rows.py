"""Row-level operators: stamping, full-row distinct, late-record filter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F

from millwright.functions import deadline, delay_hours
from millwright.schemas import INGESTED_AT

_COPIES = "_copies"


def _named(df: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in df.columns]


def stamp(df: DataFrame, as_of: datetime | Column | None = None, column: str = INGESTED_AT) -> DataFrame:
    """Append the ingestion time: the clock, or a fixed `as_of` for repeatable runs."""
    if as_of is None:
        as_of = F.current_timestamp()
    return df.withColumn(column, as_of if isinstance(as_of, Column) else F.lit(as_of))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows that agree in every column count once; NULL equals NULL.

    The partial aggregate collapses copies inside each scan task, so a row
    copied a billion times reaches the shuffle once per task.
    """
    return df.dropDuplicates()


def distinct_rows_counted(df: DataFrame, observation: Observation) -> DataFrame:
    """`distinct_rows` that also reports `rows_read` and `rows_kept` while it runs.

    Both numbers are taken after the aggregation, in the stage that writes the
    result, where a task that is run again is counted once. A counter in front
    of the shuffle would count a repeated map task twice.
    """
    return (
        df.groupBy(*_named(df))
        .agg(F.count(F.lit(1)).alias(_COPIES))
        .observe(
            observation,
            F.coalesce(F.sum(_COPIES), F.lit(0)).alias("rows_read"),
            F.count(F.lit(1)).alias("rows_kept"),
        )
        .drop(_COPIES)
    )


def distinct_stats(df: DataFrame) -> DataFrame:
    """One row: rows before and after full-row distinct, and the difference."""
    counted = df.groupBy(*_named(df)).agg(F.count(F.lit(1)).alias(_COPIES))
    read, kept = F.coalesce(F.sum(_COPIES), F.lit(0)), F.count(F.lit(1))
    return counted.agg(
        read.alias("rows_read"), kept.alias("rows_kept"), (read - kept).alias("rows_dropped")
    )


def with_delay(df: DataFrame, event: str, reference: Column, column: str = "delay_hours") -> DataFrame:
    return df.withColumn(column, delay_hours(F.col(event), reference))


def drop_late(df: DataFrame, event: str, reference: Column, max_hours: float) -> DataFrame:
    """Keep rows at most `max_hours` after `reference`.

    Rows before the reference stay; rows where either time is NULL go.
    """
    return df.where(F.col(event) <= deadline(reference, max_hours))


def of_types(df: DataFrame, column: str, wanted: tuple[str, ...] | list[str]) -> DataFrame:
    """Membership filter; unknown and NULL values go."""
    return df.where(F.col(column).isin(*wanted))
