"""Data-quality rules as aggregations.

Every rule yields rows of one report: which check, on which table and target,
what was observed, the threshold, and whether it passed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType

from millwright.functions import delay_hours
from millwright.operators.frames import total_before
from millwright.workspace import stage_counted

REPORT_COLUMNS = ("check", "table", "target", "observed", "threshold", "passed")


@dataclass(frozen=True)
class UniqueKeys:
    """No key may occur twice. Observed: all rows that share their key with another row."""

    table: str
    keys: tuple[str, ...]
    tolerance: int = 0


@dataclass(frozen=True)
class NullShare:
    """The share of NULLs (and NaNs) per column may not exceed the threshold; equal passes."""

    table: str
    columns: tuple[str, ...]
    threshold: float = 0.05


@dataclass(frozen=True)
class LateEvents:
    """Events may not lie more than `max_hours` after their reference; unknown times pass.

    By default not one event may. With `share` that share of all events may, as
    the late filter drops them; the share is observed then, and equal passes.
    """

    table: str
    event: str
    reference: str
    max_hours: float = 24
    share: float | None = None


@dataclass(frozen=True)
class RowCountDeviation:
    """The latest period's row count may not stray from the mean of the periods before it.

    With `counts` the table holds one row per period and its count in that column;
    with `series` it holds several such histories, told apart by that column.
    """

    table: str
    period: str
    tolerance: float = 0.2
    counts: str | None = None
    series: str | None = None


Rule = UniqueKeys | NullShare | LateEvents | RowCountDeviation


def _missing(df: DataFrame, column: str) -> Column:
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (FloatType, DoubleType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def _late(event: str, reference: str, max_hours: float) -> Column:
    event_time, reference_time = F.to_timestamp(F.col(event)), F.to_timestamp(F.col(reference))
    return delay_hours(event_time, reference_time) > F.lit(float(max_hours))


def _within(observed: Column, threshold: Column) -> Column:
    """True unless the observation is above the threshold; nothing observed passes."""
    return ~F.coalesce(observed > threshold, F.lit(False))


def duplicate_counts(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """One row: keys that occur more than once, and the rows in them. NULL keys are equal."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return repeated.agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
    )


def duplicate_rows(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The repeated keys themselves with their row counts."""
    keys = list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def null_shares(df: DataFrame, columns: Iterable[str], threshold: float) -> DataFrame:
    """One row per column, all counted in a single pass."""
    columns = list(columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[_count_where(_missing(df, c)).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("null_count"))
            for i, c in enumerate(columns)
        ]
    )
    share = F.try_divide(F.col("null_count"), F.col("_rows"))
    return counted.select("_rows", F.inline(entries)).select(
        "column_name",
        "null_count",
        share.alias("null_pct"),
        _within(share, F.lit(float(threshold))).alias("passed"),
    )


def late_events(df: DataFrame, event: str, reference: str, max_hours: float = 24) -> DataFrame:
    """One row: how many events are late, of how many."""
    late = _count_where(_late(event, reference, max_hours))
    return df.agg(late.alias("late_events"), F.count(F.lit(1)).alias("n_rows")).select(
        "late_events", "n_rows", (F.col("late_events") == 0).alias("passed")
    )


def row_count_deviation(
    df: DataFrame,
    period: str,
    tolerance: float = 0.2,
    *,
    counts: str | None = None,
    series: str | None = None,
) -> DataFrame:
    """Rows per period against the mean of all periods before it.

    `counts` names a column that already holds the rows of a period, one row per
    period; `series` a column that tells several histories apart. The first
    period has no history and passes, as does a history of 0. The running sums
    see one row per period: the calendar bounds a DATE, and for other types
    `total_before` measures how many there are.
    """
    group = [series] if series else []
    if counts is None:
        per_period = df.groupBy(*group, period).agg(F.count(F.lit(1)).alias("n_rows"))
    else:
        per_period = df.select(*group, period, F.col(counts).cast("bigint").alias("n_rows"))
    per_period = per_period.withColumn("_one", F.lit(1))
    earlier = [F.col(period).asc_nulls_first()]
    if isinstance(df.schema[period].dataType, DateType):
        before = Window.partitionBy(*group).orderBy(*earlier).rowsBetween(Window.unboundedPreceding, -1)
        summed = per_period.withColumns({"_sum": F.sum("n_rows").over(before), "_n": F.sum("_one").over(before)})
    else:
        stored, periods = stage_counted(per_period)
        summed = total_before(stored, group, earlier, {"_sum": "n_rows", "_n": "_one"}, rows=periods)
    deviation = F.abs(F.try_divide(F.col("n_rows") - F.col("historical_avg"), F.col("historical_avg")))
    return (
        summed.withColumn("historical_avg", F.try_divide(F.col("_sum"), F.col("_n")))
        .withColumn("deviation", deviation)
        .withColumn("passed", _within(F.col("deviation"), F.lit(float(tolerance))))
        .drop("_one", "_sum", "_n")
    )


def rule_counts(df: DataFrame, rules: Iterable[Rule]) -> dict[str, Column]:
    """What has to be counted over the rows of a table so that its row-wise rules can be answered later, by name.

    The counts can be observed while the table is written, and need no scan of their own.
    """
    counted: dict[str, Column] = {}
    for rule in rules:
        if isinstance(rule, NullShare):
            counted |= {f"nulls {c}": _count_where(_missing(df, c)) for c in rule.columns}
        elif isinstance(rule, LateEvents):
            counted[_late_name(rule)] = _count_where(_late(rule.event, rule.reference, rule.max_hours))
    return counted


def _late_name(rule: LateEvents) -> str:
    return f"late {rule.event} {rule.reference} {rule.max_hours}"


def answered(rule: Rule, rows: int, counts: Mapping[str, int]) -> list[tuple[str, str, str, float | None, float, bool]] | None:
    """The report rows of a row-wise rule from counts taken before; None if it takes more than those."""
    if isinstance(rule, NullShare):
        found = [("nulls", c, f"nulls {c}", True, rule.threshold) for c in rule.columns]
    elif isinstance(rule, LateEvents):
        strict = rule.share is None
        found = [("late_events" if strict else "late_share", rule.event, _late_name(rule), not strict, 0.0 if strict else rule.share)]
    else:
        return None
    if any(name not in counts for _, _, name, _, _ in found):
        return None
    report = []
    for check, target, name, share, threshold in found:
        observed = float(counts[name]) if not share else counts[name] / rows if rows else None
        report.append((check, rule.table, target, observed, float(threshold), observed is None or observed <= threshold))
    return report


def _report(df: DataFrame, check: str, table: str, target: str | Column, observed: Column,
            threshold: float) -> DataFrame:
    limit = F.lit(float(threshold))
    return df.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        (F.lit(target) if isinstance(target, str) else target).alias("target"),
        observed.cast("double").alias("observed"),
        limit.alias("threshold"),
        _within(observed, limit).alias("passed"),
    )


def _one_pass(df: DataFrame, table: str, rules: list[NullShare | LateEvents]) -> DataFrame:
    """All rules that only need to look at single rows, in one scan of the table."""
    entries: list[tuple[str, str, Column, float]] = []
    n_rows = F.count(F.lit(1))
    for rule in rules:
        if isinstance(rule, NullShare):
            entries += [
                ("nulls", c, F.try_divide(_count_where(_missing(df, c)), n_rows), rule.threshold)
                for c in rule.columns
            ]
        else:
            late = _count_where(_late(rule.event, rule.reference, rule.max_hours)).cast("double")
            if rule.share is None:
                entries.append(("late_events", rule.event, late, 0.0))
            else:
                entries.append(("late_share", rule.event, F.try_divide(late, n_rows), rule.share))
    observed = df.agg(*[value.alias(f"_o{i}") for i, (_, _, value, _) in enumerate(entries)])
    rows = F.array(
        *[
            F.struct(
                F.lit(check).alias("check"),
                F.lit(table).alias("table"),
                F.lit(target).alias("target"),
                F.col(f"_o{i}").alias("observed"),
                F.lit(float(threshold)).alias("threshold"),
                _within(F.col(f"_o{i}"), F.lit(float(threshold))).alias("passed"),
            )
            for i, (check, target, _, threshold) in enumerate(entries)
        ]
    )
    return observed.select(F.inline(rows))


def run_checks(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """Evaluate the rules into one report, scanning each table once for all row-wise rules."""
    by_row: dict[str, list[NullShare | LateEvents]] = {}
    reports: list[DataFrame] = []
    for rule in rules:
        df = tables[rule.table]
        if isinstance(rule, UniqueKeys):
            counts = duplicate_counts(df, rule.keys)
            reports.append(
                _report(counts, "duplicates", rule.table, ",".join(rule.keys),
                        F.col("duplicate_rows"), rule.tolerance)
            )
        elif isinstance(rule, RowCountDeviation):
            periods = row_count_deviation(
                df, rule.period, rule.tolerance, counts=rule.counts, series=rule.series
            )
            group = [rule.series] if rule.series else []
            latest = periods.groupBy(*group).agg(F.max_by("deviation", rule.period).alias("deviation"))
            target = F.col(rule.series).cast("string") if rule.series else rule.period
            reports.append(
                _report(latest, "row_count_deviation", rule.table, target,
                        F.col("deviation"), rule.tolerance)
            )
        else:
            by_row.setdefault(rule.table, []).append(rule)
    reports += [_one_pass(tables[name], name, group) for name, group in by_row.items()]
    if not reports:
        raise ValueError("no rules given")
    return reduce(DataFrame.unionByName, reports)


def all_passed(report: DataFrame) -> bool:
    return report.where(~F.col("passed")).isEmpty()


def check_duplicates(df: DataFrame, key_columns: Iterable[str], tolerance: int = 0) -> bool:
    return duplicate_counts(df, key_columns).first()["duplicate_rows"] <= tolerance


def check_nulls(df: DataFrame, critical_columns: Iterable[str], threshold_pct: float) -> bool:
    return all_passed(null_shares(df, critical_columns, threshold_pct))


def check_late_events(df: DataFrame, event_timestamp_col: str, reference_timestamp_col: str,
                      max_delay_hours: float = 24) -> bool:
    return late_events(df, event_timestamp_col, reference_timestamp_col, max_delay_hours).first()["passed"]


def check_row_count_deviation(current_count: float, historical_avg: float, tolerance: float = 0.2) -> bool:
    if historical_avg == 0:
        return True
    # Not `<=`: without any history the mean is NaN, and what cannot be compared passes.
    return not abs(current_count - historical_avg) / historical_avg > tolerance
