"""Every registered query: one callable per operator, job and indicator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone
from functools import cached_property, partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import TimestampType

import standins
from millwright import functions as fn
from millwright.operators import checks, joins, metrics, rows
from millwright.operators.frames import with_rank
from millwright.params import Params
from millwright.plans import bronze, daily, kpis, manifest, pipeline, publish, silver, stream, versions
from millwright.schemas import INGESTED_AT, RAW, SERVING
from millwright.sources import read_parquet, write_csv
from millwright.workspace import concurrently, run_folder, stage, stage_counted

Query = Callable[[SparkSession, str], DataFrame]

# Clocks are fixed so that results repeat.
AS_OF = datetime(2000, 1, 1, tzinfo=timezone.utc)
AS_OF_DATE = date(2000, 1, 1)

# Means over a frame may be summed in another order elsewhere; compare 6 places.
PLACES = 6

QUERIES: dict[str, Query] = {}


class Factory:
    """The factory tables over one folder, each read once per query."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _load(self, table: str) -> DataFrame:
        return standins.load(self.spark, self.folder, table)

    @cached_property
    def machine_logs(self) -> DataFrame:
        return self._load("machine_logs")

    @cached_property
    def production(self) -> DataFrame:
        return self._load("production_records")

    @cached_property
    def raw_inspections(self) -> DataFrame:
        return self._load("inspection_results")

    @property
    def raw_tables(self) -> dict[str, DataFrame]:
        return {
            "machine_logs": self.machine_logs,
            "production_records": self.production,
            "inspection_results": self.raw_inspections,
            "material_batches": self.materials,
        }

    @cached_property
    def inspections(self) -> DataFrame:
        # Zone-less like the test tables, so the late filter compares a bare
        # column with a literal of its own type and reaches the Parquet scan.
        return rows.stamp(self.raw_inspections, F.lit(AS_OF).cast("timestamp_ntz"))

    @cached_property
    def materials(self) -> DataFrame:
        return self._load("material_batches")

    @cached_property
    def products(self) -> DataFrame:
        return self._load("dim_product")

    @cached_property
    def machines(self) -> DataFrame:
        return self._load("dim_machine")

    @cached_property
    def shifts(self) -> DataFrame:
        return self._load("dim_shift")

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        return {"dim_product": self.products, "dim_machine": self.machines, "dim_shift": self.shifts}

    @cached_property
    def quality(self) -> DataFrame:
        return silver.quality_metrics(self.inspections, self.production)

    @cached_property
    def quality_with_product(self) -> DataFrame:
        return joins.quality_with_product(self.quality, self.production, self.products)

    @cached_property
    def inspected_production(self) -> DataFrame:
        return joins.inspections_with_production(self.inspections, self.production)

    @cached_property
    def downtime(self) -> DataFrame:
        return silver.downtime_metrics(self.machine_logs)


def register(function: Callable[[Factory], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(Factory(spark, folder))

    QUERIES[function.__name__] = run
    return run


def _zoneless(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, PLACES) for name in columns})


def _ordered(df: DataFrame, name: str) -> DataFrame:
    """The indicator stored in display order and read without a sort."""
    spark = df.sparkSession
    df = stage(df) if name in kpis.SMALL else df
    stored = publish.publish(df, name, folder=run_folder(spark), namespace=publish.ANALYTICS, order=kpis.display_order(name))
    return publish.in_order(spark, stored)


def _as_view(df: DataFrame, name: str) -> DataFrame:
    """The indicator as a view, in display order if it has one."""
    publish.register_view(_ordered(df, name) if name in kpis.DISPLAY else df, name)
    return df.sparkSession.table(name)


def _counted(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


# --- bronze ---------------------------------------------------------------


def _as_raw(df: DataFrame, dataset: str) -> DataFrame:
    """A stand-in in the layout of its raw file; columns it lacks are empty."""
    have = {"timestamp": "event_ts"} if dataset == "machine_logs" else {}
    chosen = []
    for f in RAW[dataset].fields:
        source = have.get(f.name, f.name)
        value = F.col(source) if source in df.columns else F.lit(None)
        chosen.append(value.cast(f.dataType).alias(f.name))
    return df.select(*chosen)


def _write_raw(df: DataFrame, dataset: str, folder: str) -> None:
    write_csv(_as_raw(df, dataset), f"{folder}/{dataset}.csv")


def _write_all_raw(t: Factory, folder: str) -> None:
    concurrently(t.spark, [partial(_write_raw, df, dataset, folder) for dataset, df in t.raw_tables.items()])


@register
def csv_roundtrip(t: Factory) -> DataFrame:
    base = run_folder(t.spark)
    _write_raw(t.production, "production_records", f"{base}/raw")
    bronze.ingest(
        t.spark, f"{base}/raw", f"{base}/bronze", datasets=["production_records"], as_of=AS_OF
    )
    return _zoneless(read_parquet(t.spark, f"{base}/bronze/production_records"))


@register
def bronze_table_counts(t: Factory) -> DataFrame:
    base = run_folder(t.spark)
    tables = t.raw_tables

    def counted(dataset: str) -> DataFrame:
        raw = standins.with_copies(tables[dataset], dataset)
        landed = bronze.land(raw, dataset, base, AS_OF)
        return (
            read_parquet(t.spark, landed.path)
            .agg(F.count(F.lit(1)).alias("rows_in_bronze"))
            .select(
                F.lit(dataset).alias("dataset"),
                F.lit(landed.rows_read).cast("bigint").alias("rows_read"),
                F.lit(landed.rows_dropped).cast("bigint").alias("rows_dropped"),
                "rows_in_bronze",
            )
        )

    return reduce(DataFrame.unionByName, [counted(dataset) for dataset in RAW])


@register
def bronze_ingest(t: Factory) -> DataFrame:
    return _zoneless(bronze.bronze_table(standins.with_copies(t.machine_logs, "machine_logs"), AS_OF))


@register
def bronze_dedup(t: Factory) -> DataFrame:
    return rows.distinct_rows(standins.with_copies(t.raw_inspections, "inspection_results"))


@register
def bronze_dedup_stats(t: Factory) -> DataFrame:
    return rows.distinct_stats(standins.with_copies(t.raw_inspections, "inspection_results"))


# --- silver ---------------------------------------------------------------


@register
def inspection_delay_hours(t: Factory) -> DataFrame:
    return rows.with_delay(t.inspected_production, "inspection_timestamp", F.col("end_time")).select(
        "inspection_id", "batch_id", "inspection_timestamp", "end_time", "delay_hours"
    )


@register
def silver_late_filter(t: Factory) -> DataFrame:
    return rows.drop_late(t.inspections, "inspection_timestamp", F.col(INGESTED_AT), 24)


@register
def silver_late_filter_end_time(t: Factory) -> DataFrame:
    return rows.drop_late(
        t.inspected_production, "inspection_timestamp", F.col("end_time"), 24
    ).select("inspection_id", "batch_id", "defect_found", "inspection_timestamp", "end_time")


@register
def join_inspection_production(t: Factory) -> DataFrame:
    return t.inspected_production


@register
def silver_quality(t: Factory) -> DataFrame:
    return t.quality


@register
def silver_quality_end_time(t: Factory) -> DataFrame:
    return silver.quality_metrics(t.inspections, t.production, late_reference="end_time")


@register
def silver_quality_end_time_split(t: Factory) -> DataFrame:
    """The same by way of spread hot batches."""
    return silver.quality_metrics(t.inspections, t.production, late_reference="end_time", hot_key_rows=4)


@register
def downtime_events(t: Factory) -> DataFrame:
    return silver.downtime_events(t.machine_logs)


@register
def downtime_by_type(t: Factory) -> DataFrame:
    events = silver.downtime_events(t.machine_logs)
    return metrics.minutes_by_type(events, "machine_id", "shift_id")


@register
def silver_downtime(t: Factory) -> DataFrame:
    return t.downtime


# --- indicators -----------------------------------------------------------


@register
def join_quality_product_left(t: Factory) -> DataFrame:
    return t.quality_with_product


@register
def join_quality_product_left_split(t: Factory) -> DataFrame:
    """Production holds some batches twice; their rows are spread over shares."""
    production = standins.with_copies(t.production, "production_records")
    return joins.quality_with_product(t.quality, stage(production), t.products, hot_key_rows=1)


@register
def prod_week(t: Factory) -> DataFrame:
    return t.production.select(
        "batch_id", "production_date", fn.week_start(F.col("production_date")).alias("prod_week")
    )


@register
def defect_rate_daily(t: Factory) -> DataFrame:
    daily = metrics.defects_by_category(t.quality, t.production, t.products)
    return _rounded(daily, "daily_defect_rate")


def _defect_rate(t: Factory, **options: int) -> DataFrame:
    result = kpis.kpi_defect_rate(t.quality, t.production, t.products, **options)
    return _rounded(result, "daily_defect_rate", "rolling_7d_defect_rate")


@register
def defect_rate_calendar7(t: Factory) -> DataFrame:
    return _defect_rate(t, calendar_days=7)


@register
def kpi_defect_rate(t: Factory) -> DataFrame:
    return _as_view(_defect_rate(t), "kpi_defect_rate")


@register
def batch_duration_minutes(t: Factory) -> DataFrame:
    return t.production.select(
        "batch_id",
        fn.boundary_minutes(F.col("start_time"), F.col("end_time")).alias("duration_minutes"),
    )


@register
def throughput_uph(t: Factory) -> DataFrame:
    return _rounded(metrics.units_per_hour(t.production), "prod_hours", "units_per_hour")


@register
def throughput_rank(t: Factory) -> DataFrame:
    hourly, n_rows = stage_counted(metrics.units_per_hour(t.production))
    ranked = with_rank(hourly, ["production_date"], "units_per_hour", "throughput_rank", rows=n_rows)
    return ranked.select("production_line", "shift_id", "production_date", "throughput_rank")


def _throughput(t: Factory, **options: int) -> DataFrame:
    result = kpis.kpi_throughput(t.production, **options)
    return _rounded(result, "units_per_hour", "prev_shift_uph", "pct_change_vs_prev")


@register
def kpi_throughput(t: Factory) -> DataFrame:
    return _as_view(_throughput(t), "kpi_throughput")


@register
def kpi_throughput_split(t: Factory) -> DataFrame:
    """The same by way of chunks of each line's shifts."""
    return _throughput(t, group_rows=400)


@register
def throughput_rank_split(t: Factory) -> DataFrame:
    """Ranks by line instead of by day, so that groups are large, by way of chunks."""
    hourly = stage(metrics.units_per_hour(t.production))
    ranked = with_rank(hourly, ["production_line"], "units_per_hour", "line_rank", group_rows=400)
    return ranked.select("production_line", "shift_id", "production_date", "line_rank")


@register
def kpi_downtime(t: Factory) -> DataFrame:
    downtime, n_rows = stage_counted(t.downtime)
    return _as_view(kpis.kpi_downtime(downtime, as_of=AS_OF_DATE, rows=n_rows), "kpi_downtime")


@register
def downtime_daily_cumulative(t: Factory) -> DataFrame:
    metric_rows = silver.downtime_metrics(t.machine_logs, by_date="event_ts")
    daily, n_rows = stage_counted(metric_rows)
    return kpis.kpi_downtime(daily, rows=n_rows)


@register
def downtime_daily_cumulative_split(t: Factory) -> DataFrame:
    """The same by way of chunks of each machine's days."""
    daily = stage(silver.downtime_metrics(t.machine_logs, by_date="event_ts"))
    return kpis.kpi_downtime(daily, group_rows=100)


@register
def join_material_quality(t: Factory) -> DataFrame:
    return joins.material_with_quality(t.materials, t.quality)


@register
def high_defect_flag(t: Factory) -> DataFrame:
    flag = fn.is_high_defect(F.col("defect_rate"))
    return t.quality.select(
        "production_line", "shift_id", "batch_id", "production_date", "defect_rate",
        flag.alias("is_high_defect_batch"),
    )


def _material_batch(t: Factory, **options: int) -> DataFrame:
    result = kpis.kpi_material_batch(t.materials, stage(t.quality), **options)
    return _rounded(result, "historical_avg_defect_rate_last_4")


@register
def kpi_material_batch(t: Factory) -> DataFrame:
    return _as_view(_material_batch(t), "kpi_material_batch_trends")


@register
def kpi_material_batch_split(t: Factory) -> DataFrame:
    """The same by way of spread hot batches and chunks of the larger suppliers' rows."""
    return _material_batch(t, group_rows=600, hot_key_rows=4)


def _places(df: DataFrame, name: str) -> DataFrame:
    """The display keys with the place of each row as the view shows them.

    Rows are numbered as they are read: inside a part by their position, over
    parts by how many rows the parts before hold.
    """
    shown = stage(_ordered(df, name).withColumn("_id", F.monotonically_increasing_id()))
    part, position = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = shown.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    keys = [column for column, _ in kpis.DISPLAY[name]]
    return numbered.join(offsets, "_part").select(*keys, (F.col("_before") + position + 1).alias("place"))


@register
def display_order_defect_rate(t: Factory) -> DataFrame:
    return _places(_defect_rate(t), "kpi_defect_rate")


@register
def display_order_material_batch(t: Factory) -> DataFrame:
    return _places(_material_batch(t), "kpi_material_batch_trends")


# --- checks ---------------------------------------------------------------


@register
def dq_duplicates(t: Factory) -> DataFrame:
    return checks.duplicate_counts(t.inspections, ["inspection_id"])


@register
def dq_duplicate_rows(t: Factory) -> DataFrame:
    return checks.duplicate_rows(t.inspections, ["inspection_id"])


@register
def dq_nulls(t: Factory) -> DataFrame:
    columns = ["batch_id", "product_id", "product_category", "defect_rate"]
    shares = checks.null_shares(t.quality_with_product, columns, 0.05)
    return _rounded(shares, "null_pct")


@register
def dq_late_events(t: Factory) -> DataFrame:
    return checks.late_events(t.inspected_production, "inspection_timestamp", "end_time", 24)


@register
def dq_row_count_deviation(t: Factory) -> DataFrame:
    result = checks.row_count_deviation(t.production, "production_date", 0.2)
    return _rounded(result, "historical_avg", "deviation")


@register
def dq_report(t: Factory) -> DataFrame:
    tables = {
        "inspection_results": t.inspections,
        "production_records": t.production,
        "quality_metrics": t.quality,
    }
    rules = [
        checks.UniqueKeys("inspection_results", ("inspection_id",)),
        checks.UniqueKeys("production_records", ("batch_id",)),
        checks.NullShare("quality_metrics", ("batch_id", "defect_rate"), 0.05),
        checks.NullShare("inspection_results", ("inspection_timestamp",), 0.05),
        checks.LateEvents("inspection_results", "inspection_timestamp", INGESTED_AT, 24),
        checks.RowCountDeviation("production_records", "production_date", 0.2),
    ]
    return _rounded(checks.run_checks(tables, rules), "observed")


@register
def dq_late_share(t: Factory) -> DataFrame:
    """The late inspections held against shares that may be late."""
    tables = {"inspection_results": t.inspections}
    limits = [("strict", 0.1), ("loose", 0.5)]
    reports = [
        checks.run_checks(tables, [checks.LateEvents("inspection_results", "inspection_timestamp", INGESTED_AT, 24, share)])
        .withColumn("limit", F.lit(name)) for name, share in limits
    ]
    return _rounded(reduce(DataFrame.unionByName, reports), "observed")


@register
def gate_report(t: Factory) -> DataFrame:
    """What the gate looks at before publishing, by its default rules."""
    tables = {**t.raw_tables, "inspection_results": t.inspections, "quality_metrics": t.quality, "downtime_metrics": t.downtime}
    served = {"fact_production": t.production, **t.dimensions}
    tables |= {name.upper(): publish.conform(df, name, AS_OF) for name, df in served.items()}
    return _rounded(checks.run_checks(tables, pipeline.default_rules(Params(), t.dimensions)), "observed")


# --- serving --------------------------------------------------------------


def _published(t: Factory, df: DataFrame, table: str) -> DataFrame:
    conformed = publish.conform(df, table, AS_OF)
    published = publish.publish(conformed, table, folder=run_folder(t.spark))
    return _zoneless(publish.read_published(t.spark, published))


@register
def publish_quality(t: Factory) -> DataFrame:
    return _published(t, t.quality, "fact_quality_metrics")


@register
def publish_downtime(t: Factory) -> DataFrame:
    return _published(t, t.downtime, "fact_downtime_metrics")


@register
def publish_inspection(t: Factory) -> DataFrame:
    return _published(t, t.inspections, "fact_inspection")


@register
def schema_conformance(t: Factory) -> DataFrame:
    sources = {
        "dim_machine": t.machines,
        "dim_product": t.products,
        "fact_production": t.production,
        "fact_inspection": t.inspections,
    }
    tables = {name: publish.conform(df, name, AS_OF) for name, df in sources.items()}
    rules = [rule for name in tables for rule in publish.constraint_rules(name)]
    return checks.run_checks(tables, rules)


@register
def dim_machine_defaults(t: Factory) -> DataFrame:
    return publish.conform(t.machines, "dim_machine")


# --- the whole day --------------------------------------------------------


# At the fixed clock some stand-in inspections are late; this share may be.
LATE_SHARE = 0.5


def _known_faults(rule: checks.Rule) -> bool:
    """The stand-in inspections repeat ids."""
    return rule.table == "inspection_results" and isinstance(rule, checks.UniqueKeys)


def _whole_day(t: Factory, prefix: str | None = None) -> pipeline.RunReport:
    """CSV files of all four tables, through every step, to the published indicators.

    With `prefix` everything is published to the catalog, in namespaces of that prefix.
    Nothing reads the files in front of what is published any more; they go at the end.
    """
    base = run_folder(t.spark)
    _write_all_raw(t, f"{base}/raw")
    serving = f"{base}/serving" if prefix is None else ""
    params = Params(f"{base}/raw", f"{base}/bronze", f"{base}/silver", serving, prefix or "", late_event_share=LATE_SHARE)
    dimensions = {"dim_product": t.products} if prefix is None else t.dimensions
    rules = [rule for rule in pipeline.default_rules(params, dimensions) if not _known_faults(rule)]
    try:
        return pipeline.run_pipeline(
            t.spark, params, dimensions, as_of=AS_OF, rules=rules, publish_inspections=prefix is not None
        )
    finally:
        for folder in (params.raw_path, params.bronze_path, params.silver_path):
            manifest.remove(t.spark, folder)


def _in_catalog(t: Factory, read: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """The day published to namespaces of its own, read by another session, then dropped."""
    prefix = f"day_{uuid.uuid4().hex}_"
    try:
        _whole_day(t, prefix)
        other = t.spark.newSession()
        other.conf.set("spark.sql.session.timeZone", "UTC")
        path = f"{run_folder(t.spark)}/read"
        read(other, prefix).write.parquet(path)
        return read_parquet(t.spark, path)
    finally:
        for namespace in (publish.STAGING, publish.ANALYTICS):
            t.spark.sql(f"DROP SCHEMA IF EXISTS {prefix}{namespace} CASCADE")


@register
def catalog_tables(t: Factory) -> DataFrame:
    """Rows and columns of every defined serving table, from the catalog."""
    def read(other: SparkSession, prefix: str) -> DataFrame:
        tables = {name: other.table(f"{prefix}{publish.STAGING}.{name}") for name in SERVING}
        counts = [_counted(df, name).withColumn("n_columns", F.lit(len(df.columns))) for name, df in tables.items()]
        return reduce(DataFrame.unionByName, counts)

    return _in_catalog(t, read)


@register
def catalog_kpi_throughput(t: Factory) -> DataFrame:
    """The lasting view over an indicator that was built from staging tables."""
    def read(other: SparkSession, prefix: str) -> DataFrame:
        view = other.table(f"{prefix}{publish.ANALYTICS}.kpi_throughput")
        return _rounded(view, "units_per_hour", "prev_shift_uph", "pct_change_vs_prev")

    return _in_catalog(t, read)


@register
def end_to_end(t: Factory) -> DataFrame:
    _whole_day(t)
    return _rounded(
        t.spark.table("kpi_defect_rate"), "daily_defect_rate", "rolling_7d_defect_rate"
    )


@register
def end_to_end_tables(t: Factory) -> DataFrame:
    published = _whole_day(t).published
    counts = [_counted(publish.read_published(t.spark, p), name) for name, p in published.items()]
    return reduce(DataFrame.unionByName, counts)


@register
def gate_states(t: Factory) -> DataFrame:
    """Whether a day may be published: after a passed check, after one that failed, after a new ingest, and after its metrics."""
    base = run_folder(t.spark)
    _write_all_raw(t, f"{base}/raw")
    params = Params(f"{base}/raw", f"{base}/bronze", f"{base}/silver", f"{base}/serving", late_event_share=LATE_SHARE)
    rules = pipeline.default_rules(params)
    fitting = [rule for rule in rules if not _known_faults(rule)]
    states: list[tuple[str, bool, int | None]] = []

    def note(state: str, repeated: int | None = None) -> None:
        try:
            pipeline.require_passed_gate(t.spark, params)
            allowed = True
        except RuntimeError:
            allowed = False
        states.append((state, allowed, repeated))

    def checked(state: str, chosen: list[checks.Rule]) -> None:
        try:
            pipeline.check(t.spark, params, rules=chosen, as_of=AS_OF)
            note(state)
        except pipeline.QualityGateError as failed:
            note(state, sum(int(row["observed"]) for row in failed.failures))
        except manifest.StaleTableError:
            note(state)

    pipeline.ingest_raw(t.spark, params, as_of=AS_OF)
    checked("ingested, no metrics", fitting)
    concurrently(t.spark, [partial(pipeline.build_quality, t.spark, params), partial(pipeline.build_downtime, t.spark, params)])
    note("not checked")
    checked("passed", fitting)
    checked("failed after a pass", rules)
    checked("passed again", fitting)
    pipeline.ingest_raw(t.spark, params, as_of=datetime(2000, 1, 2, tzinfo=timezone.utc))
    checked("new ingest, old metrics", fitting)
    return t.spark.createDataFrame(states, "state string, may_publish boolean, repeated_rows bigint")


@register
def gate_observed(t: Factory) -> DataFrame:
    """The gate's report on landed tables, as far as it was counted while they were written, and their repeated keys."""
    base = run_folder(t.spark)
    _write_all_raw(t, f"{base}/raw")
    params = Params(f"{base}/raw", f"{base}/bronze", f"{base}/silver", f"{base}/serving")
    pipeline.ingest_raw(t.spark, params, as_of=AS_OF)
    pipeline.build_quality(t.spark, params)
    pipeline.build_downtime(t.spark, params)
    entries, rules = pipeline.current_tables(t.spark, params), pipeline.default_rules(params)
    counted = pipeline.report_on({}, [r for r in rules if not isinstance(r, checks.UniqueKeys)], entries)
    keys = pipeline.report_on(pipeline.gate_tables(t.spark, params, {}, AS_OF), [r for r in rules if isinstance(r, checks.UniqueKeys)])
    schema = "check string, table string, target string, observed double, threshold double, passed boolean"
    return _rounded(t.spark.createDataFrame([tuple(r) for r in counted + keys], schema), "observed")


@register
def csv_quarantine(t: Factory) -> DataFrame:
    """Production landed from files in which some rows do not parse: what was kept, and what was set aside why."""
    base, schema = run_folder(t.spark), RAW["production_records"]
    text = _as_raw(t.production, "production_records").withColumn("units_produced", F.col("units_produced").cast("string"))
    units = F.when(F.col("batch_id").cast("bigint") % 10 == 3, F.concat("units_produced", F.lit("x"))).otherwise(F.col("units_produced"))
    start = F.when(F.col("batch_id").cast("bigint") % 25 == 7, F.lit("soon")).otherwise(F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"))
    spoilt = text.withColumn("units_produced", units).withColumn("start_time", start)
    spoilt.write.option("header", True).csv(f"{base}/raw/production_records.csv")
    (landed,) = bronze.ingest(
        t.spark, f"{base}/raw", f"{base}/bronze", datasets=["production_records"], as_of=AS_OF, quarantine=True
    )
    kept = read_parquet(t.spark, landed.path).select(F.lit("kept").alias("reason"))
    aside = read_parquet(t.spark, f"{base}/bronze/{bronze.QUARANTINE}/production_records").select("reason")
    totals = [("read", landed.rows_read), ("copies", landed.rows_dropped), ("rejected", landed.rows_rejected)]
    counts = kept.unionByName(aside).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.unionByName(t.spark.createDataFrame(totals, "reason string, n_rows bigint"))


@register
def publish_version(t: Factory) -> DataFrame:
    """A set of tables, read back after a second set broke off at its third table."""
    store = run_folder(t.spark)
    tables = {"dim_product": t.products, "dim_shift": t.shifts, "fact_production": t.production}

    def publish_set(sources: dict[str, DataFrame]) -> None:
        with versions.prepared(t.spark, store) as version:
            for name, df in sources.items():
                publish.publish(publish.conform(df, name, AS_OF), name, folder=versions.version_folder(store, version))
        versions.turn_folder(t.spark, store, version)

    publish_set(tables)
    broken = t.production.withColumn("units_produced", F.raise_error(F.lit("lost")).cast("int"))
    try:
        publish_set({**{name: df.limit(0) for name, df in tables.items()}, "fact_production": broken})
    except Exception as error:
        if "lost" not in str(error):
            raise
    keys = {"dim_product": "product_id", "dim_shift": "shift_id", "fact_production": "batch_id"}
    read = [
        versions.read_current(t.spark, store, publish.STAGING, name).select(F.lit(name).alias("table_name"), F.col(key).cast("string").alias("key"))
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, read)


# --- three deliveries -------------------------------------------------------

_LANDED: dict[tuple[str, str], tuple[daily.Store, daily.Store, list[daily.Delivery]]] = {}


def _delivered(t: Factory) -> tuple[daily.Store, daily.Store, list[daily.Delivery]]:
    """Three deliveries with late rows and copies, landed one after the other; once a session and folder.

    The logs are kept by day, the other tables by quarter, as they reach over years.
    """
    key = t.spark.sparkContext.applicationId, t.folder
    if key not in _LANDED:
        base = run_folder(t.spark)
        day_of = {**daily.DAY_OF, "machine_logs": "event_ts"}
        logs, rest = (
            daily.Store(Params(f"{base}/{name}/raw", f"{base}/{name}/bronze", f"{base}/{name}/silver", f"{base}/{name}/serving"), unit, day_of)
            for name, unit in (("logs", "day"), ("rest", "quarter"))
        )
        landed = []
        stamp = F.lit(AS_OF).cast("timestamp_ntz")
        for number in range(len(standins.DELIVERIES)):
            parts = {name: df.where(standins.delivered(name, number)) for name, df in t.raw_tables.items()}
            for store, names in ((logs, ["machine_logs"]), (rest, [n for n in parts if n != "machine_logs"])):
                seen = daily.land(t.spark, store, {n: parts[n] for n in names}, stamp)
                landed += [replace(d, dataset=f"{d.dataset} {number + 1}") for d in seen]
                daily.refresh(t.spark, store, t.products)
        _LANDED[key] = logs, rest, landed
    return _LANDED[key]


@register
def daily_deliveries(t: Factory) -> DataFrame:
    """What each delivery held and what of it was new."""
    counts = [(d.dataset, d.rows_read, d.rows_new) for d in _delivered(t)[2]]
    return t.spark.createDataFrame(counts, "delivery string, rows_read bigint, rows_new bigint")


@register
def daily_quality(t: Factory) -> DataFrame:
    return daily.quality_table(t.spark, _delivered(t)[1])


@register
def daily_downtime(t: Factory) -> DataFrame:
    return daily.downtime_totals(t.spark, _delivered(t)[0])


@register
def stream_downtime(t: Factory) -> DataFrame:
    """Downtime by day from a stream of log files that come one by one in no order, some rows twice."""
    base = run_folder(t.spark)
    logs = standins.with_copies(t.machine_logs, "machine_logs")
    logs.withColumn("event_ts", F.col("event_ts").cast("timestamp")).repartition(5, F.xxhash64(*logs.columns) % 97).write.parquet(f"{base}/logs")
    files = t.spark.readStream.schema(t.spark.read.parquet(f"{base}/logs").schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/logs")
    stream.write_updates(stream.live_downtime(files, "event_ts", "60 days"), f"{base}/updates", f"{base}/checkpoint")
    return stream.latest(t.spark, f"{base}/updates", ["machine_id", "production_line", "shift_id", "record_date"])


def _carried(t: Factory, logs: bool, name: str) -> DataFrame:
    store = _delivered(t)[0 if logs else 1]
    return daily.read_periods(t.spark, store.serving(name)).drop(daily.PERIOD)


@register
def daily_kpi_downtime(t: Factory) -> DataFrame:
    return _carried(t, True, "kpi_downtime")


@register
def daily_kpi_defect_rate(t: Factory) -> DataFrame:
    return _rounded(_carried(t, False, "kpi_defect_rate"), "daily_defect_rate", "rolling_7d_defect_rate")


@register
def daily_kpi_throughput(t: Factory) -> DataFrame:
    return _rounded(_carried(t, False, "kpi_throughput"), "units_per_hour", "prev_shift_uph", "pct_change_vs_prev")


@register
def daily_kpi_material_batch(t: Factory) -> DataFrame:
    return _rounded(_carried(t, False, "kpi_material_batch_trends"), "historical_avg_defect_rate_last_4")


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Land what is needed, build the quality metrics, and compute the defect-rate indicator.

    Every table is written once and read back, as in the daily run.
    """
    t = Factory(spark, folder)
    raw = {"inspection_results": t.raw_inspections, "production_records": t.production}

    def land(df: DataFrame) -> Callable[[], DataFrame]:
        return lambda: stage(bronze.bronze_table(df, AS_OF))

    inspections, production = concurrently(spark, [land(df) for df in raw.values()])
    quality = stage(silver.quality_metrics(inspections, production))
    return kpis.in_display_order(stage(kpis.kpi_defect_rate(quality, production, t.products)), "kpi_defect_rate")
