"""Deliveries day by day: land only what is new, recompute only what it touches.

Every stored table is partitioned by period (a day, or a longer unit for small
data). A delivery may hold rows of any period and copies of rows landed long
before. Rows of periods in which nothing has landed are new, and are shuffled once, to
where they are stored. In the other periods what is new is found by a hash that lies beside
each landed row, and only where hashes meet are whole rows compared. The periods of new rows are written
down before the rows are, and drive everything behind: metrics are computed
anew from those partitions and overwrite theirs. Indicators with frames go on
from the last rows of each group that were kept at the end of an earlier run.

A step that fails is run again: landing the same delivery twice adds nothing, and
touched periods stay open until each consumer has finished with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millwright.functions import availability_pct, is_high_defect, pct_change
from millwright.operators.frames import GROUP_ROWS, Measure, over_carried, with_rank
from millwright.operators.joins import material_with_quality, not_broadcast
from millwright.operators.metrics import DOWNTIME_COLUMNS, defects_by_category, units_per_hour
from millwright.operators.rows import distinct_rows_counted, stamp
from millwright.params import Params
from millwright.plans import versions
from millwright.plans.manifest import exists, remove
from millwright.plans.silver import downtime_metrics, inspected_per_batch, metrics_of_batches
from millwright.schemas import INGESTED_AT, RAW
from millwright.sources import read_csv
from millwright.workspace import concurrently, scratch, stage, stage_counted

PERIOD, ROW_HASH = "period", "row_hash"
_OTHER = "_other_"
# Rows of a delivery that one task takes, about.
SHARE_ROWS = 1 << 20
NO_DAY = 1 << 40  # the number of the day of rows without one

# The column that tells to which day a raw row belongs.
DAY_OF = {
    "machine_logs": "timestamp",
    "production_records": "production_date",
    "inspection_results": "inspection_timestamp",
    "material_batches": "received_date",
}

Periods = Sequence[date | None]


@dataclass(frozen=True)
class Store:
    """Folders of the partitioned tables, and the unit of a period (`day`, `month`, ...)."""

    params: Params
    unit: str = "day"
    day_of: Mapping[str, str] = field(default_factory=lambda: DAY_OF)

    def bronze(self, name: str) -> str:
        return f"{self.params.bronze_path}/daily/{name}"

    def silver(self, name: str) -> str:
        return f"{self.params.silver_path}/daily/{name}"

    def serving(self, name: str) -> str:
        return f"{self.params.serving_path}/daily/{name}"


@dataclass(frozen=True)
class Delivery:
    dataset: str
    rows_read: int
    rows_new: int
    periods: tuple[date | None, ...]

    @property
    def rows_dropped(self) -> int:
        return self.rows_read - self.rows_new


def period_of(day: Column, unit: str) -> Column:
    return F.date_trunc(unit, day).cast("date")


def in_periods(periods: Iterable[date | None]) -> Column:
    """A filter on the partition column; the scan lists no other partition."""
    known = [p for p in periods if p is not None]
    found = F.col(PERIOD).isin(known)
    return found | F.col(PERIOD).isNull() if None in periods else found


def read_periods(spark: SparkSession, path: str, periods: Periods | None = None) -> DataFrame:
    table = spark.read.parquet(path).withColumn(PERIOD, F.col(PERIOD).cast("date"))
    return table if periods is None else table.where(in_periods(periods))


def write_periods(df: DataFrame, path: str, *, append: bool = False, rebalance: bool = True) -> None:
    """Add to the partitions, or replace those that `df` has rows of and no others.

    Rebalancing deals rows out by period: small ones share a task, a large one gets as many as it needs.
    Without it each task writes a file of every period it holds.
    """
    writer = (df.hint("rebalance", PERIOD) if rebalance else df).write.partitionBy(PERIOD)
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _some(periods: DataFrame) -> list[date | None]:
    """Distinct periods, oldest first, a null last; the calendar bounds them."""
    return _in_order({r[0] for r in periods.select(PERIOD).distinct().collect()})


def _in_order(found: set[date | None]) -> list[date | None]:
    return sorted(found - {None}) + ([None] if None in found else [])


def stored_periods(spark: SparkSession, path: str) -> set[date | None]:
    """The periods of a stored table, from the names of its partitions."""
    if not exists(spark, path):
        return set()
    values = [n.removeprefix(f"{PERIOD}=") for n in versions.names(spark, path) if n.startswith(f"{PERIOD}=")]
    return {None if v == "__HIVE_DEFAULT_PARTITION__" else date.fromisoformat(v) for v in values}


# --- landing ----------------------------------------------------------------


def row_hash(df: DataFrame) -> Column:
    columns = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def _alike(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Rows of `left` that have (`left_semi`) or have not (`left_anti`) an equal row on the right; NULL equals NULL."""
    other = right.select(*[F.col(f"`{c}`").alias(_OTHER + c) for c in [*columns, ROW_HASH]])
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`{_OTHER}{c}`")) for c in columns]
    return left.join(not_broadcast(other), reduce(and_, same, F.col(ROW_HASH) == F.col(_OTHER + ROW_HASH)), how)


def distinct_by_period(raw: DataFrame, counts: Mapping[date | None, int], seen: Observation) -> DataFrame:
    """The distinct rows of a delivery (with their period) and their hashes, laid out as they are stored; what was kept is observed.

    Copies share a period and a hash, so one shuffle by both serves the grouping and
    the layout. A task takes about `SHARE_ROWS` rows: a large period is spread over several by
    the hash, small ones share one. `counts` are the rows of each period.
    """
    columns, before, shares = [c for c in raw.columns if c != PERIOD], 0, []
    for period, n in sorted(counts.items(), key=lambda item: (item[0] is None, item[0] or date.min)):
        first, last = before // SHARE_ROWS, (before + n - 1) // SHARE_ROWS
        shares.append((NO_DAY if period is None else (period - date(1970, 1, 1)).days, first, last - first + 1))
        before += n
    places = raw.sparkSession.createDataFrame(shares, "_day bigint, _first int, _n int")  # a row per period
    share = (F.col("_first") + F.pmod(row_hash(raw.select(*[f"`{c}`" for c in columns])), F.col("_n"))).cast("int")
    found = raw.withColumn("_day", F.coalesce(F.unix_date(PERIOD).cast("bigint"), F.lit(NO_DAY))).join(F.broadcast(places), "_day")
    spread = found.select(share.alias("_share"), PERIOD, *[f"`{c}`" for c in columns])
    return (
        spread.repartitionById(max(1, -(-before // SHARE_ROWS)), F.col("_share"))
        .groupBy("_share", PERIOD, *[f"`{c}`" for c in columns]).agg(F.lit(1).alias("_one"))
        .observe(seen, F.count(F.lit(1)).alias("rows_kept"))
        .select(*[f"`{c}`" for c in columns], PERIOD)
        .withColumn(ROW_HASH, row_hash(raw.select(*[f"`{c}`" for c in columns])))
        .select(*[f"`{c}`" for c in columns], ROW_HASH, PERIOD)
    )


def fresh_rows(raw: DataFrame, day: str, unit: str, landed: DataFrame | None) -> tuple[DataFrame, Delivery]:
    """The distinct rows of a delivery that have not been landed, with hash and period, and what was counted.

    Of the landed rows only the hashes of the delivery's periods are read, and
    whole rows only of periods in which hashes meet.
    """
    seen, columns = Observation(), raw.columns
    candidates = stage(
        distinct_rows_counted(raw, seen)
        .withColumn(ROW_HASH, row_hash(raw)).withColumn(PERIOD, period_of(F.col(f"`{day}`"), unit))
    )
    rows_read, rows_kept = seen.get["rows_read"], seen.get["rows_kept"]
    if landed is not None:
        index = not_broadcast(landed.where(in_periods(_some(candidates))).select(F.col(ROW_HASH).alias(_OTHER + ROW_HASH)))
        met, n_met = stage_counted(candidates.join(index, F.col(ROW_HASH) == F.col(_OTHER + ROW_HASH), "left_semi"))
        if n_met:
            there = landed.where(in_periods(_some(met)))
            copies, n_copies = stage_counted(_alike(met, there, columns, "left_semi"))
            candidates, rows_kept = stage(_alike(candidates, copies, columns, "left_anti")), rows_kept - n_copies
    return candidates, Delivery("", rows_read, rows_kept, tuple(_some(candidates)))


_TOUCHED = "dataset string, period date"


@dataclass(frozen=True)
class Found:
    """A delivery taken apart: rows of periods in which nothing has landed, with their numbers, and what is new in the others."""

    raw: DataFrame
    alone: dict[date | None, int]
    compared: DataFrame | None
    seen: Delivery
    rows_read: int

    @property
    def periods(self) -> tuple[date | None, ...]:
        return tuple(_in_order({*self.alone, *self.seen.periods}))


def land(spark: SparkSession, store: Store, deliveries: Mapping[str, DataFrame], as_of: datetime | Column | None = None) -> list[Delivery]:
    """Add what is new of each delivery to its table, and write down the periods it touches first."""
    def find(name: str) -> Found:
        path, day = store.bronze(name), store.day_of[name]
        raw = deliveries[name].withColumn(PERIOD, period_of(F.col(f"`{day}`"), store.unit))
        read = dict(map(tuple, raw.groupBy(PERIOD).count().collect()))  # a row per period
        there = stored_periods(spark, path)
        alone = {p: n for p, n in read.items() if p not in there}
        met, compared, seen = [p for p in read if p in there], None, Delivery("", 0, 0, ())
        if met:
            some = raw.where(in_periods(met)).drop(PERIOD)
            compared, seen = fresh_rows(some, day, store.unit, read_periods(spark, path, met))
        return Found(raw.where(in_periods(alone)), alone, compared, seen, sum(read.values()))

    def add(name: str, found: Found) -> int:
        kept, n_new = Observation(), found.seen.rows_new
        if n_new:
            write_periods(stamp(found.compared, as_of), store.bronze(name), append=True)
        if found.alone:
            rows = distinct_by_period(found.raw, found.alone, kept)
            write_periods(stamp(rows, as_of), store.bronze(name), append=True, rebalance=False)
            n_new += kept.get["rows_kept"]
        return n_new

    with scratch(spark):
        names = list(deliveries)
        found = dict(zip(names, concurrently(spark, [partial(find, name) for name in names])))
        touched = [(name, period) for name in names for period in found[name].periods]
        if touched:
            log = f"{store.bronze('touched')}/{versions.new_version()}"
            spark.createDataFrame(touched, _TOUCHED).coalesce(1).write.parquet(log)
        n_new = concurrently(spark, [partial(add, name, found[name]) for name in names])
    return [Delivery(name, found[name].rows_read, n, found[name].periods) for name, n in zip(names, n_new)]


def land_files(spark: SparkSession, store: Store, *, infer: bool = False, as_of: datetime | None = None) -> list[Delivery]:
    """`land` for the files `<raw>/<dataset>.csv` that are there; a dataset may have no delivery today."""
    paths = {name: f"{store.params.raw_path}/{name}.csv" for name in RAW}
    raw = {n: read_csv(spark, p, RAW[n], infer=infer) for n, p in paths.items() if exists(spark, p)}
    return land(spark, store, raw, as_of)


# --- what is still open -----------------------------------------------------


@dataclass(frozen=True)
class Open:
    """Periods that a consumer has not worked off yet, and up to which log entry they reach."""

    periods: dict[str, list[date | None]]
    upto: str | None


def open_periods(spark: SparkSession, store: Store, consumer: str) -> Open:
    """Periods touched since the consumer last finished, by dataset."""
    done = versions.current_version(spark, store.silver(f"progress/{consumer}"))
    logs = [v for v in versions.names(spark, store.bronze("touched")) if done is None or v > done]
    if not logs:
        return Open({}, None)
    rows = spark.read.schema(_TOUCHED).parquet(*[f"{store.bronze('touched')}/{v}" for v in logs]).distinct().collect()
    found: dict[str, list[date | None]] = {}
    for dataset, period in sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or date.min)):
        found.setdefault(dataset, []).append(period)
    return Open(found, max(logs))


def finish(spark: SparkSession, store: Store, consumer: str, work: Open) -> None:
    if work.upto is not None:
        versions.turn_folder(spark, store.silver(f"progress/{consumer}"), work.upto)


# --- metrics ----------------------------------------------------------------


def _raw(df: DataFrame) -> DataFrame:
    return df.drop(PERIOD, ROW_HASH)


def refresh_downtime(spark: SparkSession, store: Store, periods: Periods) -> None:
    """Downtime per machine, line, shift and day of the given periods, from their log partitions alone."""
    day = store.day_of["machine_logs"]
    logs = _raw(read_periods(spark, store.bronze("machine_logs"), periods))
    daily = downtime_metrics(logs, shift_minutes=store.params.shift_minutes, by_date=day)
    write_periods(daily.withColumn(PERIOD, period_of(F.col("record_date"), store.unit)), store.silver("downtime"))


def downtime_totals(spark: SparkSession, store: Store) -> DataFrame:
    """The downtime metrics over all history, from the stored days."""
    minutes = [*DOWNTIME_COLUMNS.values(), "total_downtime_mins"]
    totals = read_periods(spark, store.silver("downtime")).groupBy("machine_id", "production_line", "shift_id").agg(
        *[F.sum(c).alias(c) for c in minutes]
    )
    availability = availability_pct(F.col("total_downtime_mins"), store.params.shift_minutes)
    return totals.withColumn("machine_availability_pct", availability)


def refresh_quality(spark: SparkSession, store: Store, inspected: Periods, produced: Periods) -> list[date | None]:
    """Quality metrics of all batches that new inspections or production rows may change; returns their periods.

    Inspections are summed per batch and period of inspection, and those sums are
    stored: a batch inspected again needs no other day's raw inspections.
    """
    params, sums_path, made = store.params, store.silver("inspection_sums"), store.bronze("production_records")
    if inspected:
        rows = read_periods(spark, store.bronze("inspection_results"), inspected)
        sums = inspected_per_batch(rows, F.col(INGESTED_AT), params.max_late_event_hours, "batch_id", PERIOD)
        write_periods(sums, sums_path)
    if not (exists(spark, sums_path) and exists(spark, made)):
        return []
    affected = list(produced)
    if inspected:
        batches = not_broadcast(read_periods(spark, sums_path, inspected).select("batch_id").distinct())
        affected = list({*produced, *_some(read_periods(spark, made).join(batches, "batch_id", "left_semi"))})
    if not affected:
        return []
    per_batch = read_periods(spark, sums_path).groupBy("batch_id").agg(
        F.sum("_defects").alias("_defects"), F.sum("_inspected").alias("_inspected")
    )
    production = read_periods(spark, made, affected)
    metrics = metrics_of_batches(per_batch, production, params.hot_key_rows)
    write_periods(metrics.withColumn(PERIOD, period_of(F.col("production_date"), store.unit)), store.silver("quality_metrics"))
    return affected


def quality_table(spark: SparkSession, store: Store, periods: Periods | None = None) -> DataFrame:
    return read_periods(spark, store.silver("quality_metrics"), periods).drop(PERIOD)


# --- indicators carried over runs -------------------------------------------


def _snapshots(spark: SparkSession, path: str) -> list[date]:
    return sorted(date.fromisoformat(name.removeprefix("until=")) for name in versions.names(spark, path))


def _after(until: date | None) -> Column:
    """Partitions behind a kept tail; rows without a day come last of all, so they are always among them."""
    return F.lit(True) if until is None else (F.col(PERIOD) > F.lit(until)) | F.col(PERIOD).isNull()


def roll_forward(
    spark: SparkSession,
    store: Store,
    name: str,
    touched: Periods,
    rows_after: Callable[[Column], DataFrame],
    day: str,
    group: list[str],
    order: list[str],
    depth: int,
    measures: dict[str, Measure],
    finished: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> date | None:
    """Bring an indicator with frames up to date from the first touched period on.

    `rows_after` gives its rows behind a period, by a filter on `PERIOD`. The last
    `depth` rows of every group up to some period are kept beside the indicator; the
    latest such tail in front of all touched periods seeds the frames, so only
    partitions behind it are read. Tails that the new rows make wrong go first.
    Returns the period behind which rows were read, None for all.
    """
    tails, target = store.serving(f"tails/{name}"), store.serving(name)
    first = min((p for p in touched if p is not None), default=None)
    known = _snapshots(spark, tails)
    usable = known if first is None else [u for u in known if u < first]
    for until in set(known) - set(usable):
        remove(spark, f"{tails}/until={until}")
    since = usable[-1] if usable else None
    new, n_new = stage_counted(rows_after(_after(since)))
    tail = spark.read.schema(new.schema).parquet(f"{tails}/until={since}") if since else None
    done = over_carried(new, tail, group, order, depth, measures, group_rows=store.params.window_group_rows)
    period = period_of(F.col(day), store.unit)
    periods = [p for p in _some(new.select(period.alias(PERIOD))) if p is not None]
    # Where periods are large, every task may write a file of each, without another shuffle.
    rebalance = n_new < SHARE_ROWS * (len(periods) + 1)
    write_periods(finished(done.rows).withColumn(PERIOD, period), target, rebalance=rebalance)
    if periods:
        kept = over_carried(new.where(F.col(day).isNotNull()), tail, group, order, depth, {}).tail
        kept.write.mode("overwrite").parquet(f"{tails}/until={periods[-1]}")
    return since


def refresh_downtime_kpi(spark: SparkSession, store: Store, touched: Periods) -> date | None:
    """Running downtime per machine over its last rows, day by day."""
    minutes, n = "total_downtime_mins", store.params.downtime_window_rows

    def rows_after(behind: Column) -> DataFrame:
        return read_periods(spark, store.silver("downtime")).where(behind).drop(PERIOD)

    def total(window):
        return F.sum(minutes).over(window.rowsBetween(1 - n, 0))

    return roll_forward(
        spark, store, "kpi_downtime", touched, rows_after, "record_date", ["machine_id"],
        ["record_date", "production_line", "shift_id"], n - 1, {"cumulative_30d_downtime_mins": total},
    )


def refresh_defect_rate_kpi(spark: SparkSession, store: Store, products: DataFrame, touched: Periods) -> date | None:
    """Daily defect rates with their rolling mean; products are looked up for the new metric rows only."""
    cell, n = ["production_line", "shift_id", "product_category"], store.params.defect_window_rows

    def rows_after(behind: Column) -> DataFrame:
        quality = read_periods(spark, store.silver("quality_metrics")).where(behind)
        batches = not_broadcast(quality.select("batch_id").distinct())
        made = read_periods(spark, store.bronze("production_records")).select("batch_id", "product_id")
        made = stage(made.join(batches, "batch_id", "left_semi"))
        return defects_by_category(quality, made, products, hot_key_rows=store.params.hot_key_rows)

    def mean(window):
        return F.avg("daily_defect_rate").over(window.rowsBetween(1 - n, 0))

    return roll_forward(
        spark, store, "kpi_defect_rate", touched, rows_after, "production_date", cell,
        ["production_date"], n - 1, {"rolling_7d_defect_rate": mean},
    )


def refresh_throughput_kpi(spark: SparkSession, store: Store, touched: Periods) -> date | None:
    """Units per hour, the line's previous shift and the change; ranks stay within a day."""
    def rows_after(behind: Column) -> DataFrame:
        production = read_periods(spark, store.bronze("production_records")).where(behind)
        return units_per_hour(production).select("production_line", "shift_id", "production_date", "units_per_hour")

    def previous(window):
        return F.lag("units_per_hour", 1).over(window)

    def finished(df: DataFrame) -> DataFrame:
        changed = df.withColumn("pct_change_vs_prev", pct_change(F.col("units_per_hour"), F.col("prev_shift_uph")))
        return with_rank(stage(changed), ["production_date"], "units_per_hour", "throughput_rank", group_rows=store.params.window_group_rows)

    return roll_forward(
        spark, store, "kpi_throughput", touched, rows_after, "production_date", ["production_line"],
        ["production_date", "shift_id"], 1, {"prev_shift_uph": previous}, finished,
    )


def refresh_material_kpi(spark: SparkSession, store: Store, received: Periods, quality: Periods) -> date | None:
    """Material rows with their batch's defect rate and the supplier's recent mean.

    A batch whose metrics changed touches the days on which its material was received.
    """
    params, materials, n = store.params, store.bronze("material_batches"), store.params.supplier_window_rows
    if quality:
        changed = not_broadcast(quality_table(spark, store, quality).select("batch_id").distinct())
        received = list({*received, *_some(read_periods(spark, materials).join(changed, "batch_id", "left_semi"))})
    if not received:
        return None

    def rows_after(behind: Column) -> DataFrame:
        some = read_periods(spark, materials).where(behind)
        joined = material_with_quality(some, quality_table(spark, store), hot_key_rows=params.hot_key_rows)
        return joined.withColumn("is_high_defect_batch", is_high_defect(F.col("defect_rate"), params.high_defect_pct))

    def mean(window):
        return F.avg("defect_rate").over(window.rowsBetween(-n, -1))

    return roll_forward(
        spark, store, "kpi_material_batch_trends", received, rows_after, "received_date", ["supplier_id"],
        ["received_date", "batch_id", "material_id", "defect_rate"], n, {"historical_avg_defect_rate_last_4": mean},
    )


def refresh(spark: SparkSession, store: Store, products: DataFrame | None = None) -> dict[str, list[date | None]]:
    """Work off all open periods: both metric tables, then (given the products) the indicators.

    Returns the periods that were recomputed, by metric table. The progress mark is
    set last, so a run that breaks off is repeated from the same list.
    """
    work = open_periods(spark, store, "refresh")
    if work.upto is None:
        return {}
    logs, inspected, produced, received = (
        work.periods.get(n, []) for n in ("machine_logs", "inspection_results", "production_records", "material_batches")
    )
    done: dict[str, list[date | None]] = {}
    with scratch(spark):
        if logs:
            refresh_downtime(spark, store, logs)
            done["downtime"] = logs
        changed = refresh_quality(spark, store, inspected, produced) if inspected or produced else []
        if changed:
            done["quality_metrics"] = changed
        if products is not None:
            jobs: list[Callable[[], date | None]] = []
            if logs:
                jobs.append(partial(refresh_downtime_kpi, spark, store, logs))
            if changed:
                jobs.append(partial(refresh_defect_rate_kpi, spark, store, products, changed))
            if produced:
                jobs.append(partial(refresh_throughput_kpi, spark, store, produced))
            if (received or changed) and exists(spark, store.bronze("material_batches")) and exists(spark, store.silver("quality_metrics")):
                jobs.append(partial(refresh_material_kpi, spark, store, received, changed))
            concurrently(spark, jobs)
    finish(spark, store, "refresh", work)
    return done


def run_day(
    spark: SparkSession, params: Params, products: DataFrame, *, unit: str = "day", infer: bool = False, as_of: datetime | None = None
) -> tuple[list[Delivery], dict[str, list[date | None]]]:
    """Land today's files and bring metrics and indicators up to date."""
    store = Store(params, unit)
    landed = land_files(spark, store, infer=infer, as_of=as_of)
    return landed, refresh(spark, store, products)
