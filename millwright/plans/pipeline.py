"""The whole day: raw files to indicators, with checks in front of the serving tables.

Each step reads what the step before it wrote, so a step can be run again on
its own: ingest, quality and downtime, check, publish, indicators. Every step
records what it wrote and from what (`manifest`). A passed check is tied to
those records: it is withdrawn before tables are looked at again, and no longer
counts once any table has changed. Tables and indicators are published as one
version. Independent jobs of a step run side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from millwright.operators.checks import (
    REPORT_COLUMNS, LateEvents, NullShare, RowCountDeviation, Rule, UniqueKeys, answered, rule_counts, run_checks,
)
from millwright.params import Params
from millwright.plans import kpis, versions
from millwright.plans.bronze import Ingested, ingest
from millwright.plans.manifest import Entry, exists, recorded, remove, require_current, write_recorded
from millwright.plans.publish import (
    ANALYTICS, STAGING, Published, conform, constraint_rules, create_tables, create_view, in_order, in_order_sql,
    n_files, namespace_folder, publish, read_published, register_view,
)
from millwright.plans.silver import downtime_metrics, quality_metrics
from millwright.schemas import INGESTED_AT, RAW
from millwright.sources import read_parquet, write_parquet
from millwright.workspace import concurrently, release_shuffles, scratch, stage

_HISTORY = "row_count_history"
_HISTORY_SCHEMA = "dataset string, run_at timestamp, n_rows bigint"
# Beside the tables: what the last ingest read and kept, and the tables that last passed the gate.
_COUNTS = "ingest_counts"
_COUNTS_SCHEMA = "dataset string, path string, rows_read bigint, rows_kept bigint, rows_rejected bigint, run_at timestamp"
_PASSED = "gate_passed"
_PASSED_SCHEMA = "table string, content string, files string"
_METRICS = ("quality_metrics", "downtime_metrics")


class QualityGateError(RuntimeError):
    """Raised before anything is published; carries the failed report rows."""

    def __init__(self, failures: list[Row]) -> None:
        self.failures = failures
        super().__init__("; ".join(
            f"{row['check']} on {row['table']}.{row['target']}: "
            f"{row['observed']} against {row['threshold']}"
            for row in failures
        ))


@dataclass
class RunReport:
    ingested: list[Ingested] = field(default_factory=list)
    checks: list[Row] = field(default_factory=list)
    published: dict[str, Published] = field(default_factory=dict)
    views: list[str] = field(default_factory=list)


def bronze(spark: SparkSession, params: Params, name: str) -> DataFrame:
    return read_parquet(spark, f"{params.bronze_path}/{name}")


def silver(spark: SparkSession, params: Params, name: str) -> DataFrame:
    return read_parquet(spark, f"{params.silver_path}/{name}")


# Rules on a serving table that is a copy of a raw one are answered by what was counted there.
_COPY_OF = {"FACT_PRODUCTION": "production_records"}


def _observable(params: Params) -> dict[str, list[Rule]]:
    """The row-wise default rules by the raw or metric table whose rows answer them."""
    found: dict[str, list[Rule]] = {}
    for rule in default_rules(params):
        found.setdefault(_COPY_OF.get(rule.table, rule.table), []).append(rule)
    return found


def _to_observe(params: Params) -> dict[str, Callable[[DataFrame], dict[str, Column]]]:
    return {table: partial(rule_counts, rules=rules) for table, rules in _observable(params).items()}


def _observed(params: Params, table: str, df: DataFrame) -> dict[str, Column]:
    return rule_counts(df, _observable(params).get(table, []))


def _inputs(spark: SparkSession, params: Params, *names: str) -> dict[str, str]:
    """Fingerprints of the raw tables a metric table is about to be made from."""
    return {name: entry.content for name, entry in recorded(spark, params.bronze_path, names).items()}


def build_quality(spark: SparkSession, params: Params, late_reference: str = INGESTED_AT) -> None:
    made_from = _inputs(spark, params, "inspection_results", "production_records")
    with scratch(spark):
        metrics = quality_metrics(
            bronze(spark, params, "inspection_results"), bronze(spark, params, "production_records"),
            max_late_hours=params.max_late_event_hours, late_reference=late_reference,
            hot_key_rows=params.hot_key_rows,
        )
        counts = _observed(params, "quality_metrics", metrics)
        write_recorded(metrics, params.silver_path, "quality_metrics", made_from, counts)


def build_downtime(spark: SparkSession, params: Params) -> None:
    made_from = _inputs(spark, params, "machine_logs")
    metrics = downtime_metrics(bronze(spark, params, "machine_logs"), shift_minutes=params.shift_minutes)
    counts = _observed(params, "downtime_metrics", metrics)
    write_recorded(metrics, params.silver_path, "downtime_metrics", made_from, counts)


def _history(spark: SparkSession, params: Params) -> tuple[DataFrame, str]:
    """Row counts of the accepted runs, a few rows per run; empty before the first."""
    path = f"{params.silver_path}/{_HISTORY}"
    if exists(spark, path):
        return spark.read.schema(_HISTORY_SCHEMA).parquet(path), path
    return spark.createDataFrame([], _HISTORY_SCHEMA), path


def ingest_raw(
    spark: SparkSession, params: Params, *, infer: bool = False, as_of: datetime | None = None
) -> list[Ingested]:
    """Land all raw files and store what was read and kept, one row per dataset."""
    run_at = as_of or datetime.now()
    ingested = ingest(
        spark, params.raw_path, params.bronze_path, infer=infer, as_of=as_of,
        quarantine=params.max_rejected_share is not None, counts=_to_observe(params),
    )
    counts = [(i.dataset, i.path, i.rows_read, i.rows_kept, i.rows_rejected, run_at) for i in ingested]
    table = spark.createDataFrame(counts, _COUNTS_SCHEMA).coalesce(1)
    write_parquet(table, f"{params.bronze_path}/{_COUNTS}")
    return ingested


def last_ingest(spark: SparkSession, params: Params) -> tuple[list[Ingested], datetime | None]:
    """What the last ingest kept, and when it ran; nothing if none was stored."""
    path = f"{params.bronze_path}/{_COUNTS}"
    if not exists(spark, path):
        return [], None
    rows = spark.read.schema(_COUNTS_SCHEMA).parquet(path).collect()
    return [Ingested(r.dataset, r.path, r.rows_read, r.rows_kept, r.rows_rejected) for r in rows], rows[0].run_at


def current_tables(spark: SparkSession, params: Params) -> dict[str, Entry]:
    """What the steps have recorded of raw and metric tables; an error if a table is absent, changed or out of date."""
    layers = {name: params.bronze_path for name in RAW} | {name: params.silver_path for name in _METRICS}
    entries = recorded(spark, params.bronze_path, RAW) | recorded(spark, params.silver_path, _METRICS)
    require_current(spark, layers, entries)
    return entries


def require_passed_gate(spark: SparkSession, params: Params) -> None:
    """An error unless the tables as they are now have passed the last check."""
    path = f"{params.silver_path}/{_PASSED}"
    passed = spark.read.schema(_PASSED_SCHEMA).parquet(path).collect() if exists(spark, path) else []
    if not passed:
        raise RuntimeError("the last ingest has not passed the check; run it before publishing")
    now = {entry.mark for entry in current_tables(spark, params).values()}
    if now != {tuple(row) for row in passed}:
        raise RuntimeError("tables were written again and have not passed the check since; run it before publishing")


def require_dimensions(dimensions: Mapping[str, DataFrame]) -> None:
    """An error unless `dim_product` is there and every dimension has its columns."""
    if "dim_product" not in dimensions:
        raise ValueError("dim_product is needed: no raw file carries the product categories")
    for name, df in dimensions.items():
        conform(df, name)


def serving_sources(
    spark: SparkSession, params: Params, dimensions: Mapping[str, DataFrame], *, inspections: bool = False
) -> dict[str, DataFrame]:
    """What each serving table is filled from."""
    sources = {
        "fact_quality_metrics": silver(spark, params, "quality_metrics"),
        "fact_downtime_metrics": silver(spark, params, "downtime_metrics"),
        "fact_production": bronze(spark, params, "production_records"),
        "material_batches": bronze(spark, params, "material_batches"),
        **dimensions,
    }
    if inspections:
        sources["fact_inspection"] = bronze(spark, params, "inspection_results")
    return sources


def gate_tables(
    spark: SparkSession, params: Params, dimensions: Mapping[str, DataFrame], as_of: datetime | None = None
) -> dict[str, DataFrame]:
    """The tables that rules may name: raw ones as landed, both metric tables, and the serving tables.

    Serving tables go by their upper-case names, as they are in the store, and are
    looked at in the form that would be published.
    """
    tables = {name: bronze(spark, params, name) for name in RAW}
    tables |= {name: silver(spark, params, name) for name in ("quality_metrics", "downtime_metrics")}
    served = serving_sources(spark, params, dimensions, inspections=True)
    return tables | {name.upper(): conform(df, name, as_of) for name, df in served.items()}


def default_rules(params: Params, dimensions: Iterable[str] = ()) -> list[Rule]:
    """Keys and required columns of what is published, raw keys, late events, and the metric tables' keys.

    The metric tables come out of groupings by their keys, so what can go wrong
    with them is NULL keys; repeated keys can only be in raw and serving tables.
    """
    grains = {
        "quality_metrics": ("production_line", "shift_id", "batch_id", "production_date"),
        "downtime_metrics": ("machine_id", "production_line", "shift_id"),
    }
    rules: list[Rule] = []
    for table, keys in grains.items():
        rules.append(UniqueKeys(table, keys, params.duplicate_tolerance))
        rules.append(NullShare(table, keys, params.null_threshold_pct))
    rules.append(UniqueKeys("inspection_results", ("inspection_id",), params.duplicate_tolerance))
    rules.append(LateEvents(
        "inspection_results", "inspection_timestamp", INGESTED_AT, params.max_late_event_hours, params.late_event_share
    ))
    for table in ("fact_production", *dimensions):
        rules += [replace(rule, table=table.upper()) for rule in constraint_rules(table)]
    return rules


def report_on(
    tables: Mapping[str, DataFrame], rules: Iterable[Rule], entries: Mapping[str, Entry] | None = None
) -> list[Row]:
    """The report of all rules, without regard to whether they passed.

    What was counted while a table was written answers the rules about its single
    rows; only the others read tables. The report has one row per rule and
    column, so bringing it to the driver is bounded by the rules, not by the data.
    """
    report, left = [], []
    for rule in rules:
        entry = (entries or {}).get(_COPY_OF.get(rule.table, rule.table))
        known = answered(rule, entry.rows, entry.counts) if entry else None
        if known is None:
            left.append(rule)
        else:
            report += [Row(*REPORT_COLUMNS)(*row) for row in known]
    return report + (run_checks(tables, left).collect() if left else [])


def gate(
    tables: Mapping[str, DataFrame], rules: Iterable[Rule], entries: Mapping[str, Entry] | None = None, also: Iterable[Row] = ()
) -> list[Row]:
    """Run the rules; raise if any of them, or of the rows reported `also`, failed, else return the report."""
    report = [*report_on(tables, rules, entries), *also]
    failures = [row for row in report if not row["passed"]]
    if failures:
        raise QualityGateError(failures)
    return report


def rejected_shares(ingested: Iterable[Ingested], limit: float | None) -> list[Row]:
    """A report row per dataset: the share of raw rows that did not parse against what is allowed."""
    if limit is None:
        return []
    shares = [(i.dataset, i.rows_rejected / i.rows_read if i.rows_read else None) for i in ingested]
    return [
        Row(*REPORT_COLUMNS)("rejected_share", name, "rows", share, float(limit), share is None or share <= limit)
        for name, share in shares
    ]


def check(
    spark: SparkSession,
    params: Params,
    ingested: Iterable[Ingested] | None = None,
    *,
    dimensions: Mapping[str, DataFrame] | None = None,
    rules: Iterable[Rule] | None = None,
    as_of: datetime | None = None,
    accept_row_counts: bool = False,
) -> list[Row]:
    """The gate over raw, metric and serving tables and the row counts of this run.

    The count of every ingested dataset (by default of the last ingest) is held
    against the mean of the accepted runs before it. A run that passes joins that
    history, and may be published: its mark names the tables as they are. The mark
    of an earlier check is taken away first, and metric tables that were not made
    from the raw tables as they are now are refused. Where volumes have changed for good, no run
    would pass again: `accept_row_counts` leaves that one rule out for this run
    and takes its counts into the history.
    """
    dimensions = dimensions or {}
    remove(spark, f"{params.silver_path}/{_PASSED}")
    entries = current_tables(spark, params)
    stored, stored_at = last_ingest(spark, params)
    ingested = stored if ingested is None else list(ingested)
    run_at = as_of or stored_at or datetime.now()
    tables = gate_tables(spark, params, dimensions, as_of)
    rules = list(default_rules(params, dimensions) if rules is None else rules)
    current = spark.createDataFrame([(i.dataset, run_at, i.rows_kept) for i in ingested], _HISTORY_SCHEMA)
    history, path = _history(spark, params)
    if ingested and not accept_row_counts:
        datasets = [i.dataset for i in ingested]
        earlier = history.where((F.col("run_at") < F.lit(run_at)) & F.col("dataset").isin(datasets))
        tables[_HISTORY] = earlier.unionByName(current)
        rules.append(RowCountDeviation(
            _HISTORY, "run_at", params.row_count_variance_pct, counts="n_rows", series="dataset"
        ))
    with scratch(spark):
        report = gate(tables, rules, entries, rejected_shares(ingested, params.max_rejected_share))
    if ingested and history.where(F.col("run_at") == F.lit(run_at)).isEmpty():
        current.coalesce(1).write.mode("append").parquet(path)
    marks = spark.createDataFrame([entry.mark for entry in entries.values()], _PASSED_SCHEMA).coalesce(1)
    write_parquet(marks, f"{params.silver_path}/{_PASSED}")
    return report


def publish_tables(
    spark: SparkSession,
    params: Params,
    dimensions: Mapping[str, DataFrame],
    folder: str,
    as_of: datetime | None = None,
    *,
    inspections: bool = False,
) -> dict[str, Published]:
    """Both metric tables, the facts behind the indicators, and the dimensions, written below `folder`.

    No indicator reads single inspections, by far the largest table, so they are
    copied to the serving store only on request.
    """
    sources = serving_sources(spark, params, dimensions, inspections=inspections)
    jobs = [partial(publish, conform(df, name, as_of), name, folder=folder) for name, df in sources.items()]
    return dict(zip(sources, concurrently(spark, jobs)))


def kpi_jobs(
    tables: Mapping[str, DataFrame], params: Params, as_of: datetime | None = None, ranges: int | None = None
) -> dict[str, Callable[[], DataFrame]]:
    """How to build each indicator from the serving tables; `ranges` for a write in display order."""
    limits = {"group_rows": params.window_group_rows}
    return {
        "kpi_defect_rate": partial(
            kpis.kpi_defect_rate,
            tables["fact_quality_metrics"], tables["fact_production"], tables["dim_product"],
            window_rows=params.defect_window_rows, hot_key_rows=params.hot_key_rows,
        ),
        "kpi_throughput": partial(kpis.kpi_throughput, tables["fact_production"], **limits),
        "kpi_downtime": partial(
            kpis.kpi_downtime, tables["fact_downtime_metrics"],
            as_of=as_of.date() if as_of else None, window_rows=params.downtime_window_rows, **limits,
        ),
        "kpi_material_batch_trends": partial(
            kpis.kpi_material_batch, tables["material_batches"], tables["fact_quality_metrics"],
            high_defect_pct=params.high_defect_pct, window_rows=params.supplier_window_rows,
            hot_key_rows=params.hot_key_rows, ranges=ranges, **limits,
        ),
    }


def refresh_kpis(
    spark: SparkSession, params: Params, published: Mapping[str, Published], folder: str, as_of: datetime | None = None
) -> dict[str, Published]:
    """Indicators as tables of the analytics namespace below `folder`, from the published tables, in display order."""
    tables = {name: read_published(spark, p) for name, p in published.items()}
    builders = kpi_jobs(tables, params, as_of, n_files(spark))

    def store(name: str) -> Published:
        df = builders[name]()
        df = stage(df) if name in kpis.SMALL else df
        return publish(df, name, folder=folder, namespace=ANALYTICS, order=kpis.display_order(name))

    with scratch(spark):
        return dict(zip(builders, concurrently(spark, [partial(store, name) for name in builders])))


def _into_catalog(spark: SparkSession, prefix: str, written: Mapping[str, Published]) -> dict[str, Published]:
    """Turn the catalog's tables to the written ones; indicators are `<NAME>_DATA` with a lasting view on top."""
    create_tables(spark, prefix=prefix)
    named = {}
    for name, table in written.items():
        is_indicator = f"/{ANALYTICS}/" in table.location
        full = f"{name}_data".upper() if is_indicator else table.table
        named[name] = replace(table, table=full, location=f"{prefix}{ANALYTICS if is_indicator else STAGING}.{full}")
    versions.turn_catalog(spark, {named[name].location: table.location for name, table in written.items()})
    for name, table in named.items():
        if table.table.endswith("_DATA"):
            query = in_order_sql(written[name]) or f"SELECT * FROM {table.location}"
            create_view(spark, f"{prefix}{ANALYTICS}.{name}", query)
    return named


def publish_all(
    spark: SparkSession,
    params: Params,
    dimensions: Mapping[str, DataFrame],
    as_of: datetime | None = None,
    *,
    inspections: bool = False,
) -> dict[str, Published]:
    """Tables and indicators as one new version of the store; if anything fails, readers keep the one before.

    Each indicator has a view of its name on top. In the catalog the view lasts;
    over a folder there is no catalog to keep it, so it lives as long as the
    session, and `versions.read_current` finds the tables.
    """
    prefix = params.catalog_prefix
    if params.serving_path:
        store = params.serving_path
    else:
        create_tables(spark, prefix=prefix)
        store = namespace_folder(spark, f"{prefix}{STAGING}")
    with versions.prepared(spark, store) as version:
        folder = versions.version_folder(store, version)
        written = publish_tables(spark, params, dimensions, folder, as_of, inspections=inspections)
        indicators = refresh_kpis(spark, params, written, folder, as_of)
    if params.serving_path:
        versions.turn_folder(spark, store, version)
        for name, table in indicators.items():
            register_view(in_order(spark, table) if table.order else read_published(spark, table), name)
        written |= indicators
    else:
        written = _into_catalog(spark, prefix, written | indicators)
    versions.forget(spark, store, version)
    return written


def run_pipeline(
    spark: SparkSession,
    params: Params,
    dimensions: Mapping[str, DataFrame],
    *,
    as_of: datetime | None = None,
    late_reference: str = INGESTED_AT,
    rules: Iterable[Rule] | None = None,
    infer: bool = False,
    publish_inspections: bool = False,
    accept_row_counts: bool = False,
) -> RunReport:
    """Ingest, build both metric tables, check, publish, and refresh the indicators.

    `dimensions` must hold `dim_product` (no raw file carries it) and may hold
    the other dimensions. An empty `serving_path` publishes to the catalog.
    """
    require_dimensions(dimensions)
    run = RunReport()
    run.ingested = ingest_raw(spark, params, infer=infer, as_of=as_of)
    concurrently(spark, [
        partial(build_quality, spark, params, late_reference),
        partial(build_downtime, spark, params),
    ])
    run.checks = check(
        spark, params, run.ingested, dimensions=dimensions, rules=rules, as_of=as_of,
        accept_row_counts=accept_row_counts,
    )
    release_shuffles(spark)
    run.published = publish_all(spark, params, dimensions, as_of, inspections=publish_inspections)
    run.views = [name for name in run.published if name in kpis.INDICATORS]
    return run
