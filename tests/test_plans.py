"""The physical plans keep the shape they were designed for."""

import re

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from catalog import Factory
from millwright.operators import metrics
from millwright.plans import kpis

HEAVY = ["silver_quality", "silver_quality_end_time", "silver_downtime", "kpi_defect_rate", "kpi_throughput",
         "kpi_downtime", "kpi_material_batch", "dq_report", "bronze_ingest", "defect_rate_calendar7",
         "join_material_quality", "join_quality_product_left", "join_inspection_production"]


def plan(spark, folder, name):
    return queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """Plans as they look when no side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", HEAVY)
def test_nothing_leaves_the_jvm_or_crosses(spark, testdata, name, shuffled):
    text = plan(spark, testdata, name)
    for node in ("Python", "Pandas", "MapIn", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_late_limit_reaches_the_scan(spark, testdata):
    text = plan(spark, testdata, "silver_late_filter")
    assert "LessThanOrEqual(l_shipdate,2000-01-02" in text


def test_type_filter_reaches_the_scan_and_columns_are_pruned(spark, tmp_path):
    from millwright.plans import silver
    from millwright.schemas import RAW

    path = str(tmp_path / "logs")
    spark.createDataFrame([], RAW["machine_logs"]).write.parquet(path)
    text = silver.downtime_metrics(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "In(event_type" in text
    assert "timestamp" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_quality_shuffles_each_side_once_and_reuses_the_batch_partitioning(spark, testdata, shuffled):
    text = plan(spark, testdata, "silver_quality")
    assert text.count("Exchange") == 2
    # Inspections are summed per batch before they move.
    assert text.index("partial_sum(defect_found") > text.index("Exchange hashpartitioning(batch_id")


def test_production_is_shuffled_once(spark, testdata, shuffled):
    """Rows go to their batch's partition, are combined there, and join there."""
    assert plan(spark, testdata, "silver_quality_end_time").count("Exchange") == 2
    t = Factory(spark, testdata)
    text = metrics.defects_by_category(t.quality, t.production, t.products)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 7
    hot = metrics.defects_by_category(t.quality, t.production.unionAll(t.production), t.products, hot_key_rows=1)
    assert hot._jdf.queryExecution().executedPlan().toString().count("Exchange") == 8


def test_one_window_per_specification(spark, testdata):
    assert plan(spark, testdata, "kpi_throughput").count("Window [") == 2
    # Stored before it is sorted for display, so the sort does not repeat the window.
    assert plan(spark, testdata, "kpi_material_batch").count("Window [") == 0
    t = Factory(spark, testdata)
    unsorted = kpis.kpi_material_batch(t.materials, t.quality)
    assert unsorted._jdf.queryExecution().executedPlan().toString().count("Window [") == 1


def test_material_rows_are_shuffled_and_computed_once_for_their_display(spark, tmp_path, shuffled):
    """Suppliers lie in ranges behind the join; neither the window nor the write in order shuffles again."""
    from millwright.plans import publish
    from millwright.workspace import stage

    supplier = F.when(F.col("id") % 11 != 0, F.concat(F.lit("S"), F.col("id") % 37))
    materials = stage(spark.range(900).select(
        (F.col("id") % 300).cast("string").alias("batch_id"), (F.col("id") % 5).cast("string").alias("material_id"),
        supplier.alias("supplier_id"), F.when(F.col("id") % 13 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 17).cast("int"))).alias("received_date"),
    ))
    quality = stage(spark.range(280).select(F.col("id").cast("string").alias("batch_id"), (F.col("id") % 9).cast("double").alias("defect_rate")))
    name, wanted = "kpi_material_batch_trends", kpis.kpi_material_batch(materials, quality)
    ranged = kpis.kpi_material_batch(materials, quality, ranges=publish.n_files(spark))
    text = ranged._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 3 and text.count("Window [") == 1 and "rangepartitioning" not in text
    stored = publish.publish(ranged, name, folder=str(tmp_path), namespace="analytics", order=kpis.display_order(name))
    read = publish.in_order(spark, stored)
    assert read.columns == wanted.columns and len(stored.files) > 1
    assert [tuple(r) for r in read.collect()] == [tuple(r) for r in kpis.in_display_order(wanted, name).collect()]


def test_inspection_ids_are_not_shuffled(spark, tmp_path, shuffled):
    from millwright.plans import silver
    from millwright.schemas import BRONZE

    tables = {}
    for name in ("inspection_results", "production_records"):
        spark.createDataFrame([], BRONZE[name]).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    for reference in ("ingestion_timestamp", "end_time"):
        df = silver.quality_metrics(*tables.values(), late_reference=reference)
        text = df._jdf.queryExecution().executedPlan().toString()
        shuffles = [line for line in text.splitlines() if "Exchange" in line or "Sort " in line]
        assert shuffles and not any("inspection_id" in line for line in shuffles)
        assert "xxhash64" not in text
