"""Files in, indicators out."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import standins
from catalog import _as_raw
from conftest import rows
from millwright.operators.checks import LateEvents, NullShare, UniqueKeys
from millwright.params import Params
from millwright.plans import bronze, manifest, pipeline, publish, versions
from millwright.schemas import BRONZE, RAW, SERVING, SILVER
from millwright.sources import read_csv
from millwright.workspace import concurrently, run_folder, scratch, shared_folder, stage

AS_OF = datetime(2000, 1, 1)


@pytest.fixture(scope="module")
def params(spark, testdata, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    for dataset in RAW:
        raw = _as_raw(standins.load(spark, testdata, dataset), dataset)
        if dataset == "inspection_results":
            # One row per key, and every row twice.
            raw = raw.dropDuplicates(["inspection_id"])
            raw = raw.union(raw)
        raw.write.option("header", True).csv(f"{base}/raw/{dataset}.csv")
    return Params(f"{base}/raw", f"{base}/bronze", f"{base}/silver", f"{base}/serving")


@pytest.fixture(scope="module")
def dimensions(spark, testdata):
    return {name: standins.load(spark, testdata, name) for name in ("dim_product", "dim_machine")}


def on_time(params, dimensions):
    """The default rules but for late events: at the fixed clock, some inspections are."""
    return [r for r in pipeline.default_rules(params, dimensions) if not isinstance(r, LateEvents)]


@pytest.fixture(scope="module")
def run(spark, params, dimensions):
    rules = on_time(params, dimensions)
    return pipeline.run_pipeline(spark, params, dimensions, as_of=AS_OF, rules=rules, publish_inspections=True)


def test_bronze(spark, params, run):
    seen = {i.dataset: i for i in run.ingested}
    assert set(seen) == set(RAW)
    inspections = seen["inspection_results"]
    assert inspections.rows_dropped == inspections.rows_kept == inspections.rows_read // 2
    for name, schema in BRONZE.items():
        stored = spark.read.parquet(f"{params.bronze_path}/{name}")
        assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in schema]
        assert stored.count() == seen[name].rows_kept


def test_silver_schema(spark, params, run):
    for name, schema in SILVER.items():
        stored = spark.read.parquet(f"{params.silver_path}/{name}").schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in schema]


def test_everything_is_published(spark, run):
    assert set(run.published) == {
        "fact_quality_metrics", "fact_downtime_metrics", "fact_production", "fact_inspection",
        "material_batches", "dim_product", "dim_machine", "kpi_defect_rate", "kpi_throughput",
        "kpi_downtime", "kpi_material_batch_trends",
    }
    for name, published in run.published.items():
        stored = publish.read_published(spark, published)
        assert stored.count() == published.rows > 0
        assert published.table == name.upper() and published.location.endswith("/" + name.upper())
        if name in SERVING:
            declared = SERVING[name].columns
            assert [(f.name, f.dataType) for f in stored.schema] == [(f.name, f.dataType) for f in declared]


def test_views_read_the_published_indicators(spark, run):
    assert run.views == ["kpi_defect_rate", "kpi_throughput", "kpi_downtime", "kpi_material_batch_trends"]
    first = spark.sql("SELECT min(throughput_rank), max(units_per_hour) FROM kpi_throughput").first()
    assert first[0] == 1 and first[1] > 0
    every_day = spark.sql("SELECT production_date FROM kpi_throughput GROUP BY 1 HAVING min(throughput_rank) <> 1")
    assert every_day.isEmpty()
    rates = spark.sql("SELECT * FROM kpi_defect_rate WHERE NOT daily_defect_rate BETWEEN 0 AND 100")
    assert rates.isEmpty()
    for view, column in [("kpi_material_batch_trends", "historical_avg_defect_rate_last_4"), ("kpi_downtime", "machine_availability_pct")]:
        assert dict(spark.table(view).dtypes)[column] == "double"
    dates = [r[0] for r in spark.sql("SELECT production_date FROM kpi_defect_rate").collect()]
    assert dates == sorted(dates, reverse=True)
    assert run.checks and all(row["passed"] for row in run.checks)


def test_second_run_gives_the_same(spark, params, dimensions, run):
    before = {name: rows(publish.read_published(spark, p)) for name, p in run.published.items()}
    again = pipeline.run_pipeline(spark, params, dimensions, as_of=AS_OF, rules=on_time(params, dimensions))
    after = {name: rows(publish.read_published(spark, p)) for name, p in again.published.items()}
    assert set(before) - set(after) == {"fact_inspection"}
    assert after == {name: before[name] for name in after}


def test_small_chunks_give_the_same(spark, params, run):
    tables = {
        name: publish.read_published(spark, p) for name, p in run.published.items() if not name.startswith("kpi")
    }
    chunked = pipeline.kpi_jobs(tables, replace(params, window_group_rows=20, hot_key_rows=2), AS_OF)
    for name, build in chunked.items():
        stored = publish.read_published(spark, run.published[name])
        assert rows(build().select(stored.columns)) == rows(stored)


def test_gate_stops_before_publishing(spark, params, dimensions, tmp_path):
    rules = [UniqueKeys("quality_metrics", ("production_line",)), NullShare("quality_metrics", ("batch_id",))]
    closed = replace(params, serving_path=str(tmp_path / "serving"))
    with pytest.raises(pipeline.QualityGateError) as failed:
        pipeline.run_pipeline(spark, closed, dimensions, as_of=AS_OF, rules=rules)
    assert [row["check"] for row in failed.value.failures] == ["duplicates"]
    assert "quality_metrics.production_line" in str(failed.value)
    assert not (tmp_path / "serving").exists()


def test_row_counts_are_held_against_accepted_runs(spark, params, run):
    later = datetime(2000, 1, 2)
    steady = [replace(i, rows_kept=int(i.rows_kept * 1.19)) for i in run.ingested]
    jump = [replace(i, rows_kept=int(i.rows_kept * 2)) for i in run.ingested[:1]]
    rules = on_time(params, ())
    with pytest.raises(pipeline.QualityGateError) as failed:
        pipeline.check(spark, params, jump, rules=rules, as_of=later)
    assert [row["check"] for row in failed.value.failures] == ["row_count_deviation"]
    report = pipeline.check(spark, params, steady, rules=rules, as_of=later)
    assert sum(row["check"] == "row_count_deviation" for row in report) == 4
    history = spark.read.parquet(f"{params.silver_path}/row_count_history")
    assert history.groupBy("run_at").count().count() == 2 and history.count() == 8
    # A lasting change is accepted on request, once, and later runs are held against it too.
    accepted = pipeline.check(spark, params, jump, rules=rules, as_of=datetime(2000, 1, 3), accept_row_counts=True)
    assert all(row["check"] != "row_count_deviation" for row in accepted)
    assert spark.read.parquet(f"{params.silver_path}/row_count_history").count() == 9


@pytest.fixture
def small(tmp_path):
    """Params over a tiny consistent day; a function adds production rows to it."""
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "machine_logs.csv").write_text(
        "machine_id,timestamp,event_type,duration_minutes,production_line,shift_id\nM1,2024-01-01 01:00:00,idle,10,A,S1\n"
    )
    (raw / "inspection_results.csv").write_text(
        "inspection_id,batch_id,defect_found,defect_type,measurement_value,inspector_id,inspection_timestamp\n"
        "I1,B1,0,,1.5,X,2024-01-01 09:00:00\nI2,B1,1,scratch,2.5,X,2024-01-01 09:30:00\n"
    )
    (raw / "material_batches.csv").write_text("batch_id,material_id,supplier_id,received_date,quality_grade\nB1,MT,SP,2024-01-01,A\n")

    def made(*more: str) -> Params:
        lines = ["B1,P1,A,S1,100,2024-01-01,2024-01-01 00:00:00,2024-01-01 06:00:00", *more]
        header = "batch_id,product_id,production_line,shift_id,units_produced,production_date,start_time,end_time"
        (raw / "production_records.csv").write_text("\n".join([header, *lines]) + "\n")
        return Params(str(raw), f"{tmp_path}/b", f"{tmp_path}/s", f"{tmp_path}/out")

    return made


@pytest.fixture
def product(spark):
    return {"dim_product": spark.createDataFrame([("P1", "pumps", 3.5)], "product_id string, product_category string, unit_price double")}


def test_a_clean_day_passes_the_default_rules(spark, small, product):
    run = pipeline.run_pipeline(spark, small(), product, as_of=datetime(2024, 1, 1, 12))
    assert run.published["kpi_defect_rate"].rows == 1 and all(row["passed"] for row in run.checks)


def test_raw_faults_stop_the_run(spark, small, product, tmp_path):
    """A repeated batch, missing units and a late inspection; nothing is published."""
    params = small("B1,P2,A,S1,,2024-01-01,2024-01-01 00:00:00,2024-01-01 06:00:00")
    with pytest.raises(pipeline.QualityGateError) as failed:
        pipeline.run_pipeline(spark, params, product, as_of=datetime(2023, 12, 1))
    found = {(row["check"], row["table"], row["target"]) for row in failed.value.failures}
    assert found == {
        ("duplicates", "FACT_PRODUCTION", "batch_id"), ("nulls", "FACT_PRODUCTION", "units_produced"),
        ("late_events", "inspection_results", "inspection_timestamp"),
    }
    assert not (tmp_path / "out").exists()
    with pytest.raises(RuntimeError, match="not passed"):
        pipeline.require_passed_gate(spark, params)


def test_repeated_inspections_and_products_stop_the_run(spark, small, product, tmp_path):
    params = small()
    with open(f"{params.raw_path}/inspection_results.csv", "a") as more:
        more.write("I2,B1,0,,2.5,X,2024-01-01 09:30:00\n")
    twice = {"dim_product": product["dim_product"].unionAll(product["dim_product"])}
    with pytest.raises(pipeline.QualityGateError) as failed:
        pipeline.run_pipeline(spark, params, twice, as_of=datetime(2024, 1, 1, 12))
    assert {row["table"] for row in failed.value.failures} == {"inspection_results", "DIM_PRODUCT"}
    assert not (tmp_path / "out").exists()


def test_missing_dimension_is_noticed_first(spark, small, tmp_path):
    for given in ({}, {"dim_product": spark.range(1).toDF("x")}):
        with pytest.raises(ValueError, match="product"):
            pipeline.run_pipeline(spark, small(), given)
    assert not (tmp_path / "b").exists()


def test_steps_report_as_the_whole_day_does(spark, small, product):
    as_of = datetime(2024, 1, 1, 12)
    whole = pipeline.run_pipeline(spark, small(), product, as_of=as_of).checks
    params = small()
    with pytest.raises(RuntimeError):
        pipeline.require_passed_gate(spark, replace(params, silver_path=params.silver_path + "x"))
    pipeline.ingest_raw(spark, params, as_of=as_of)
    pipeline.build_quality(spark, params)
    pipeline.build_downtime(spark, params)
    by_steps = pipeline.check(spark, params, dimensions=product, as_of=as_of)
    assert sorted(map(str, by_steps)) == sorted(map(str, whole))
    assert sum(row["check"] == "row_count_deviation" for row in by_steps) == 4
    pipeline.require_passed_gate(spark, params)
    pipeline.ingest_raw(spark, params, as_of=datetime(2024, 1, 2))
    with pytest.raises(RuntimeError):
        pipeline.require_passed_gate(spark, params)


def _steps(spark, params, as_of):
    pipeline.ingest_raw(spark, params, as_of=as_of)
    pipeline.build_quality(spark, params)
    pipeline.build_downtime(spark, params)


def test_a_failed_second_check_takes_the_pass_away(spark, small, product):
    params, as_of = small(), datetime(2024, 1, 1, 12)
    _steps(spark, params, as_of)
    pipeline.check(spark, params, dimensions=product, as_of=as_of)
    pipeline.require_passed_gate(spark, params)
    with pytest.raises(pipeline.QualityGateError):
        pipeline.check(spark, params, dimensions=product, rules=[UniqueKeys("inspection_results", ("batch_id",))], as_of=as_of)
    with pytest.raises(RuntimeError, match="not passed"):
        pipeline.require_passed_gate(spark, params)


def test_metric_tables_of_an_older_ingest_are_refused(spark, small, product):
    params = small()
    _steps(spark, params, datetime(2024, 1, 1, 12))
    pipeline.ingest_raw(spark, small("B2,P1,A,S1,70,2024-01-02,2024-01-02 00:00:00,2024-01-02 06:00:00"), as_of=datetime(2024, 1, 1, 12))
    with pytest.raises(manifest.StaleTableError, match="quality_metrics was made from another production_records"):
        pipeline.check(spark, params, dimensions=product, as_of=datetime(2024, 1, 1, 12))
    pipeline.build_quality(spark, params)
    pipeline.check(spark, params, dimensions=product, as_of=datetime(2024, 1, 1, 12), accept_row_counts=True)
    pipeline.require_passed_gate(spark, params)


def test_tables_changed_behind_the_steps_are_refused(spark, small, product):
    params, as_of = small(), datetime(2024, 1, 1, 12)
    _steps(spark, params, as_of)
    pipeline.check(spark, params, dimensions=product, as_of=as_of)
    spark.read.parquet(f"{params.silver_path}/downtime_metrics").limit(1).write.mode("append").parquet(f"{params.silver_path}/downtime_metrics")
    with pytest.raises(manifest.StaleTableError, match="downtime_metrics changed"):
        pipeline.require_passed_gate(spark, params)
    with pytest.raises(manifest.StaleTableError):
        pipeline.check(spark, params, dimensions=product, as_of=as_of)
    manifest.remove(spark, f"{params.bronze_path}/manifest/machine_logs")
    with pytest.raises(manifest.StaleTableError, match="no finished step has written machine_logs"):
        pipeline.check(spark, params, dimensions=product, as_of=as_of)


def test_what_was_counted_in_the_write_is_not_read_again(spark, small, product, monkeypatch):
    params, as_of = replace(small(), late_event_share=0.4), datetime(2024, 1, 1, 9) - timedelta(hours=24)
    _steps(spark, params, as_of)
    entries = pipeline.current_tables(spark, params)
    rules = pipeline.default_rules(params, ["dim_product"])
    tables = pipeline.gate_tables(spark, params, product, as_of)
    scanned, run_checks = [], pipeline.run_checks
    monkeypatch.setattr(pipeline, "run_checks", lambda tables, rules: scanned.extend(rules) or run_checks(tables, rules))
    told = pipeline.report_on(tables, rules, entries)
    left = [r for r in scanned if not isinstance(r, UniqueKeys)]
    assert [r.table for r in left] == ["DIM_PRODUCT"]  # a dimension is not written by any step
    assert sorted(map(str, told)) == sorted(map(str, pipeline.report_on(tables, rules)))
    assert any(row["check"] == "late_share" and row["observed"] == 0.5 and not row["passed"] for row in told)
    # A rule that nobody asked for beforehand is answered by a scan.
    scanned.clear()
    (row,) = pipeline.report_on(tables, [NullShare("quality_metrics", ("defect_rate",))], entries)
    assert row["passed"] and len(scanned) == 1


def test_rows_that_do_not_parse_are_set_aside(spark, small, product):
    bad = ["B2,P1,A,S1,many,2024-01-02,2024-01-02 00:00:00,2024-01-02 06:00:00"] * 2 + ["B3,P1,A", "B4,P1,A,S1,7,someday,2024-01-02 00:00:00,late"]
    good = "B5,P1,A,S1,,2024-01-02,2024-01-02 00:00:00,2024-01-02 06:00:00"
    with pytest.raises(Exception):
        pipeline.ingest_raw(spark, small(*bad))
    params = replace(small(*bad, good, good), max_rejected_share=0.6)
    found = {i.dataset: i for i in pipeline.ingest_raw(spark, params, as_of=datetime(2024, 1, 1, 12))}
    made = found["production_records"]
    assert (made.rows_read, made.rows_kept, made.rows_dropped, made.rows_rejected) == (7, 2, 1, 4)
    aside = spark.read.parquet(f"{params.bronze_path}/quarantine/production_records")
    assert rows(aside.select("raw_text", "reason", "n_rows")) == sorted([
        (bad[0], "does not fit: units_produced", 2), (bad[2], "3 values for 8 columns", 1), (bad[3], "does not fit: production_date, end_time", 1),
    ])
    kept = spark.read.parquet(f"{params.bronze_path}/production_records")
    assert sorted(r.batch_id for r in kept.collect()) == ["B1", "B5"] and "raw_text" not in kept.columns
    pipeline.build_quality(spark, params)
    pipeline.build_downtime(spark, params)
    rules = [r for r in pipeline.default_rules(params) if r.table != "FACT_PRODUCTION"]
    report = pipeline.check(spark, params, rules=rules, as_of=datetime(2024, 1, 1, 12))
    assert {row["observed"] for row in report if row["check"] == "rejected_share"} == {0.0, 4 / 7}
    with pytest.raises(pipeline.QualityGateError, match="rejected_share on production_records"):
        pipeline.check(spark, replace(params, max_rejected_share=0.5), rules=rules, as_of=datetime(2024, 1, 1, 12))
    # A clean delivery leaves nothing aside.
    clean = replace(small(), max_rejected_share=0.0)
    assert all(i.rows_rejected == 0 for i in pipeline.ingest_raw(spark, clean, as_of=datetime(2024, 1, 2)))
    assert not manifest.exists(spark, f"{clean.bronze_path}/quarantine/production_records")


def test_fingerprints(spark):
    def content(rows, schema="a int, b string"):
        return manifest.content_of(spark.createDataFrame(rows, schema).repartition(3).agg(*manifest.fingerprint(spark.createDataFrame(rows, schema))).first().asDict())

    assert content([(1, "x"), (2, None)]) == content([(2, None), (1, "x")])
    different = [[(1, "x")], [(1, "x"), (1, "x")], [(1, None)], [(None, "x")], [(None, None)], [], [(1, "x")] * 3]
    assert len({content(rows) for rows in different}) == len(different)
    assert content([(None, "x")], "a string, b string") != content([("x", None)], "a string, b string")


def test_rows_are_hashed_before_they_are_observed(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "x", None), (2, None, 0.5), (2, None, 0.5)], "a int, first string, `b.c` double")
    written, write = [], manifest.write_parquet
    monkeypatch.setattr(manifest, "write_parquet", lambda df, path: written.append(df) or write(df, path))
    entry = manifest.write_recorded(df, str(tmp_path), "t", counts={"nulls first": F.count_if(F.col("first").isNull())})
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    observed = [line for line in plan if "CollectMetrics" in line]
    assert len(observed) == 1 and "xxhash64" not in observed[0] and any("xxhash64" in line for line in plan)
    assert entry.content == manifest.content_of(df.agg(*manifest.fingerprint(df)).first().asDict())
    assert (entry.rows, entry.counts) == (3, {"nulls first": 2})
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert stored.columns == df.columns and sorted(map(str, stored.collect())) == sorted(map(str, df.collect()))
    assert manifest.write_recorded(df.limit(0), str(tmp_path), "t").content == f"0:{0:032x}"


def test_a_share_of_late_inspections_may_pass(spark, small, product):
    params, as_of = replace(small(), late_event_share=0.5), datetime(2024, 1, 1, 9) - timedelta(hours=24)
    run = pipeline.run_pipeline(spark, params, product, as_of=as_of)
    (late,) = [row for row in run.checks if row["check"] == "late_share"]
    assert (late["observed"], late["threshold"], late["passed"]) == (0.5, 0.5, True)
    with pytest.raises(pipeline.QualityGateError, match="late_share"):
        pipeline.run_pipeline(spark, replace(params, late_event_share=0.4), product, as_of=as_of)


def _some_tables(spark, n):
    return {name: spark.range(n).selectExpr(f"cast(id as string) {key}") for name, key in (("dim_a", "a"), ("dim_b", "b"), ("dim_c", "c"))}


def test_a_failure_at_the_third_table_leaves_the_old_set(spark, tmp_path):
    store = str(tmp_path)

    def publish_set(tables, fails=False):
        with versions.prepared(spark, store) as version:
            folder = versions.version_folder(store, version)
            for i, (name, df) in enumerate(tables.items()):
                df = df.withColumn("x", F.raise_error(F.lit("boom")).cast("string")) if fails and i == 2 else df
                publish.publish(df, name, folder=folder)
        versions.turn_folder(spark, store, version)
        versions.forget(spark, store, version)

    with pytest.raises(LookupError):
        versions.read_current(spark, store, "staging", "dim_a")
    publish_set(_some_tables(spark, 3))
    with pytest.raises(Exception, match="boom"):
        publish_set(_some_tables(spark, 5), fails=True)
    assert len(versions.versions(spark, store)) == 1
    assert [versions.read_current(spark, store, "staging", t).count() for t in ("dim_a", "dim_b", "dim_c")] == [3, 3, 3]
    held = versions.read_current(spark, store, "staging", "dim_a")
    publish_set(_some_tables(spark, 5))
    assert held.count() == 3  # a reader of the version before is not disturbed
    assert versions.read_current(spark, store, "staging", "dim_c").count() == 5
    publish_set(_some_tables(spark, 6))
    assert len(versions.versions(spark, store)) == versions.KEPT


def test_a_failed_run_leaves_the_catalog_as_it_was(spark, small, product, monkeypatch):
    params = replace(small(), serving_path="", catalog_prefix="safe_")
    try:
        pipeline.run_pipeline(spark, params, product, as_of=datetime(2024, 1, 1, 12))
        before = {t: rows(spark.table(f"safe_{t}")) for t in ("staging.FACT_PRODUCTION", "analytics.kpi_defect_rate")}
        more = replace(small("B2,P1,A,S1,70,2024-01-02,2024-01-02 00:00:00,2024-01-02 06:00:00"), serving_path="", catalog_prefix="safe_")

        def broken(*_, **__):
            raise OSError("disk gone")

        with monkeypatch.context() as patch:
            patch.setattr(pipeline.kpis, "kpi_downtime", broken)
            with pytest.raises(OSError):
                pipeline.run_pipeline(spark, more, product, as_of=datetime(2024, 1, 1, 12), accept_row_counts=True)
        assert {t: rows(spark.table(f"safe_{t}")) for t in before} == before
        pipeline.run_pipeline(spark, more, product, as_of=datetime(2024, 1, 1, 12), accept_row_counts=True)
        assert spark.newSession().table("safe_staging.FACT_PRODUCTION").count() == 2
    finally:
        for namespace in (publish.STAGING, publish.ANALYTICS):
            spark.sql(f"DROP SCHEMA IF EXISTS safe_{namespace} CASCADE")


def test_steps_from_the_command_line(spark, params, dimensions, tmp_path):
    from millwright.__main__ import main

    products = str(tmp_path / "products")
    dimensions["dim_product"].write.parquet(products)
    config = tmp_path / "pipeline.yaml"
    config.write_text(
        f"storage: {{raw_layer_path: {params.raw_path}, bronze_layer_path: {tmp_path}/b, "
        f"silver_layer_path: {tmp_path}/s, serving_layer_path: {tmp_path}/out}}"
    )
    with pytest.raises(RuntimeError, match="not passed"):
        main(["publish", "--config", str(config), "--dimension", f"dim_product={products}"], spark)
    for step in ("ingest", "quality", "downtime", "check", "publish"):
        main([step, "--config", str(config), "--dimension", f"dim_product={products}"], spark)
    by_steps = versions.read_current(spark, f"{tmp_path}/out", "analytics", "kpi_defect_rate").count()
    main(["run", "--config", str(config), "--dimension", f"dim_product={products}", "--late-reference", "end_time"], spark)
    by_end_time = versions.read_current(spark, f"{tmp_path}/out", "analytics", "kpi_defect_rate").count()
    assert by_steps > 0 and by_end_time > 0
    main(["day", "--config", str(config), "--dimension", f"dim_product={products}", "--unit", "year"], spark)
    by_day = spark.read.parquet(f"{tmp_path}/out/daily/kpi_defect_rate").count()
    assert by_day == by_steps
    with pytest.raises(SystemExit):
        main(["unknown", "--config", str(config)], spark)


def test_run_into_the_catalog(spark, params, dimensions, run):
    pipeline.run_pipeline(
        spark, replace(params, serving_path=""), dimensions, as_of=AS_OF, rules=on_time(params, dimensions)
    )
    other = spark.newSession()
    views = {"kpi_defect_rate", "kpi_throughput", "kpi_downtime", "kpi_material_batch_trends"}
    assert {r["viewName"] for r in other.sql("SHOW VIEWS IN analytics").collect() if not r["isTemporary"]} == views
    assert views | {f"{v}_data" for v in views} == {
        r["tableName"] for r in other.sql("SHOW TABLES IN analytics").collect() if not r["isTemporary"]
    }
    stored = publish.read_published(spark, run.published["kpi_throughput"])
    assert rows(other.table("analytics.KPI_THROUGHPUT")) == rows(stored)
    dates = [r[0] for r in other.sql("SELECT production_date FROM analytics.kpi_defect_rate").collect()]
    assert dates == sorted(dates, reverse=True)


def test_a_table_stored_in_order_is_read_without_a_sort(spark, tmp_path):
    df = spark.range(5000).select((F.rand(3) * 40).cast("int").alias("k"), F.when(F.col("id") % 50 != 0, F.col("id")).alias("v"))
    order = [F.col("k").desc_nulls_last(), F.col("v").asc_nulls_last()]
    published = publish.publish(df, "ranked", folder=str(tmp_path), namespace="analytics", order=order)
    read = publish.in_order(spark, published)
    assert published.rows == 5000 and len(published.files) > 1
    found = [tuple(r) for r in read.collect()]
    assert found == [tuple(r) for r in df.orderBy(*order).collect()]
    text = read._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in text and "Exchange" not in text
    again = publish.Published(published.table, published.location, published.rows, published.order)
    assert [tuple(r) for r in publish.in_order(spark, again).collect()] == found
    assert [tuple(r) for r in spark.sql(publish.in_order_sql(published)).collect()] == found
    empty = publish.publish(df.limit(0), "nothing", folder=str(tmp_path), order=order)
    assert publish.in_order(spark, empty).collect() == []
    with pytest.raises(ValueError):
        publish.publish(df, "ranked", order=order)


def test_lasting_views_are_not_sorted_when_read(spark, small, product):
    params = replace(small(), serving_path="", catalog_prefix="seen_")
    try:
        pipeline.run_pipeline(spark, params, product, as_of=datetime(2024, 1, 1, 12))
        for name in ("kpi_defect_rate", "kpi_material_batch_trends"):
            view = spark.newSession().table(f"seen_analytics.{name}")
            assert view.count() == 1 and "Sort" not in view._jdf.queryExecution().executedPlan().toString()
    finally:
        for namespace in (publish.STAGING, publish.ANALYTICS):
            spark.sql(f"DROP SCHEMA IF EXISTS seen_{namespace} CASCADE")


def test_conform_defaults_and_missing_columns(spark):
    machines = spark.createDataFrame(
        [(1, "A", None, "extra"), (2, "B", "RETIRED", "extra")], "MACHINE_ID int, production_line string, status string, more string"
    )
    assert rows(publish.conform(machines, "dim_machine")) == [
        ("1", "A", None, None, "ACTIVE"), ("2", "B", None, None, "RETIRED"),
    ]
    without_status = publish.conform(machines.drop("status"), "dim_machine")
    assert {r["status"] for r in without_status.collect()} == {"ACTIVE"}
    with pytest.raises(ValueError):
        publish.conform(machines.drop("production_line"), "dim_machine")


def test_conform_shift_and_availability(spark):
    shift = spark.createDataFrame([("S1", "early", "06:00:00", "14:00:00")], "shift_id string, shift_name string, start_time string, end_time string")
    assert rows(publish.conform(shift, "dim_shift")) == [("S1", "early", "06:00:00", "14:00:00")]
    far_below = spark.sql("SELECT 'M' machine_id, -1798.33D machine_availability_pct, 10L total_downtime_mins")
    assert float(publish.conform(far_below, "fact_downtime_metrics").first()["machine_availability_pct"]) == -1798.33


def test_constraints_become_rules():
    assert publish.constraint_rules("dim_machine") == [
        UniqueKeys("dim_machine", ("machine_id",)),
        NullShare("dim_machine", ("machine_id", "production_line"), 0.0),
    ]
    assert publish.constraint_rules("fact_quality_metrics") == []


def test_publish_to_the_catalog(spark):
    publish.create_namespaces(spark)
    df = spark.range(3).selectExpr("cast(id as string) batch_id", "id * 2 AS n")
    for expected in (3, 1):
        published = publish.publish(df.limit(expected), "plain_table")
        assert (published.location, published.rows) == ("staging.PLAIN_TABLE", expected)
        assert publish.read_published(spark, published).count() == expected
    spark.sql("DROP TABLE staging.plain_table")


def test_defined_tables_keep_their_definition(spark):
    publish.create_tables(spark)
    publish.create_tables(spark)
    spark.sql("INSERT INTO staging.dim_machine (machine_id, production_line) VALUES ('0', 'A')")
    assert spark.table("staging.dim_machine").first()["status"] == "ACTIVE"
    machines = spark.createDataFrame([(1, "A", "RETIRED"), (2, "B", None)], "machine_id int, production_line string, status string")
    for _ in range(2):
        published = publish.publish(publish.conform(machines, "dim_machine"), "dim_machine")
        stored = publish.read_published(spark, published)
        assert published.rows == 2
        assert rows(stored.select("machine_id", "status")) == [("1", "RETIRED"), ("2", "ACTIVE")]
    described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED staging.dim_machine").collect()}
    assert described["Comment"] == SERVING["dim_machine"].comment
    for table, spec in SERVING.items():
        defined = spark.table(f"staging.{table}").schema
        assert [(f.name, f.dataType) for f in defined] == [(f.name, f.dataType) for f in spec.columns]


def test_failed_publish_raises(spark, tmp_path):
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    with pytest.raises(Exception, match="boom"):
        publish.publish(broken, "dim_product", folder=str(tmp_path))


def test_csv_header_and_values_are_checked(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("batch_id,material_id,supplier_id,received_date,quality_grade\nB,M,,2024-01-02,None\n")
    schema = RAW["material_batches"]
    assert rows(read_csv(spark, str(good), schema)) == [("B", "M", None, date(2024, 1, 2), "None")]
    assert rows(read_csv(spark, str(good), infer=True)) == [("B", "M", None, date(2024, 1, 2), "None")]
    swapped = tmp_path / "swapped.csv"
    swapped.write_text("material_id,batch_id,supplier_id,received_date,quality_grade\nM,B,S,2024-01-02,A\n")
    bad = tmp_path / "bad.csv"
    bad.write_text("batch_id,material_id,supplier_id,received_date,quality_grade\nB,M,S,soon,A\n")
    for path in (swapped, bad):
        with pytest.raises(Exception):
            read_csv(spark, str(path), schema).collect()
    with pytest.raises(ValueError):
        read_csv(spark, str(good))


def test_missing_file_stops_the_ingest(spark, tmp_path):
    with pytest.raises(Exception):
        bronze.ingest(spark, str(tmp_path), str(tmp_path / "bronze"))


def test_params_from_configuration(tmp_path):
    text = """
storage: {raw_layer_path: /r, bronze_layer_path: /b, silver_layer_path: /s/}
pipeline_settings: {max_late_event_hours: 12, schedule_interval: daily}
data_quality: {null_threshold_pct: 0.1}
"""
    path = tmp_path / "c.yaml"
    path.write_text(text)
    got = Params.from_yaml(str(path), shift_minutes=300.0)
    assert got == Params("/r", "/b", "/s/", "/s_serving", max_late_event_hours=12, null_threshold_pct=0.1, shift_minutes=300.0)
    with pytest.raises(ValueError):
        Params(defect_window_rows=0)


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark).startswith("file:" + spark.conf.get("spark.checkpoint.dir"))
    assert run_folder(spark) != run_folder(spark)


def test_scratch_is_removed(spark):
    import os

    with scratch(spark) as folder:
        assert stage(spark.range(3)).count() == 3
        assert os.listdir(folder.removeprefix("file:"))
    assert not os.path.exists(folder.removeprefix("file:"))


def test_jobs_side_by_side(spark):
    done = []

    def fail():
        raise ValueError("second")

    with scratch(spark) as folder:
        frames = concurrently(spark, [lambda n=n: stage(spark.range(n)) for n in (3, 5)])
        assert [df.count() for df in frames] == [3, 5]
        paths = [path for df in frames for path in df.inputFiles()]
        assert paths and all(folder.removeprefix("file:") in path for path in paths)
    with pytest.raises(ValueError, match="second"):
        concurrently(spark, [lambda: done.append(1), fail, lambda: done.append(3)])
    assert sorted(done) == [1, 3]
    assert concurrently(spark, []) == []


def test_left_folders_go_with_the_program(spark):
    import os

    from millwright import workspace

    before, workspace._LEFT = workspace._LEFT, set()
    try:
        kept = stage(spark.range(3))
        path = kept.inputFiles()[0].removeprefix("file://")
        assert kept.count() == 3 and os.path.exists(path) and len(workspace._LEFT) == 1
        workspace._remove_left_folders()
        assert not os.path.exists(path)
    finally:
        workspace._LEFT = before


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "spark://host:7077", "k8s://host"])
def test_no_temporary_folder_on_a_cluster(master):
    from types import SimpleNamespace

    context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(RuntimeError):
        shared_folder(session)
