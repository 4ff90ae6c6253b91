"""Hand-written rows at the edges of the metric definitions."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millwright import functions as fn
from millwright.operators import joins, metrics
from millwright.operators.rows import distinct_rows, distinct_rows_counted, distinct_stats, drop_late, stamp
from millwright.plans import kpis, silver

DAY = date(2024, 1, 1)
NOON = datetime(2024, 1, 1, 12)

INSPECTION = "inspection_id string, batch_id string, defect_found int, inspection_timestamp timestamp, ingestion_timestamp timestamp"
PRODUCTION = "batch_id string, product_id string, production_line string, shift_id string, production_date date, end_time timestamp"
LOG = "machine_id string, timestamp timestamp, event_type string, duration_minutes int, production_line string, shift_id string"
QUALITY = "production_line string, shift_id string, batch_id string, production_date date, defect_count bigint, total_inspected bigint, defect_rate double"


def inspection(spark, *data):
    return spark.createDataFrame(list(data), INSPECTION)


def production(spark, *batches):
    data = [(b, "P1", "A", "S1", DAY, NOON) for b in batches]
    return spark.createDataFrame(data, PRODUCTION)


@pytest.mark.parametrize("reference", ["ingestion_timestamp", "end_time"])
def test_late_by_the_limit_stays_and_a_second_more_goes(spark, reference):
    late = [
        ("exact", "B", 1, NOON + timedelta(hours=24), NOON),
        ("over", "B", 1, NOON + timedelta(hours=24, seconds=1), NOON),
        ("early", "B", 0, NOON - timedelta(days=400), NOON),
        ("unknown", "B", 1, None, NOON),
    ]
    result = silver.quality_metrics(inspection(spark, *late), production(spark, "B"), late_reference=reference)
    assert rows(result) == [("A", "S1", "B", DAY, 1, 2, 50.0)]


def test_fractional_limit(spark):
    df = inspection(
        spark, ("in", "B", 0, NOON + timedelta(minutes=90), NOON), ("out", "B", 0, NOON + timedelta(minutes=91), NOON)
    )
    kept = drop_late(df, "inspection_timestamp", F.col("ingestion_timestamp"), 1.5)
    assert [r["inspection_id"] for r in kept.collect()] == ["in"]


@pytest.mark.parametrize("reference", ["ingestion_timestamp", "end_time"])
def test_no_inspected_units_gives_rate_zero(spark, reference):
    df = inspection(spark, (None, "B", 1, NOON, NOON), (None, "B", 0, NOON, NOON))
    result = silver.quality_metrics(df, production(spark, "B"), late_reference=reference)
    assert rows(result) == [("A", "S1", "B", DAY, 1, 0, 0.0)]


def test_unknown_batch_and_uninspected_batch_are_absent(spark):
    df = inspection(spark, ("1", "B", 0, NOON, NOON), ("2", "X", 1, NOON, NOON), ("3", None, 1, NOON, NOON))
    result = silver.quality_metrics(df, production(spark, "B", "C", None))
    assert [r["batch_id"] for r in result.collect()] == ["B"]


@pytest.mark.parametrize("reference", ["ingestion_timestamp", "end_time"])
@pytest.mark.parametrize("hot", [2, 1_000_000])
def test_repeated_batches_count_like_the_row_level_join(spark, reference, hot):
    inspections = inspection(
        spark,
        *[(str(i) if i % 5 else None, f"B{i % 3 if i % 2 else 0}", i % 2 if i % 7 else None,
           NOON + timedelta(hours=i), NOON) for i in range(60)],
    )
    made = spark.createDataFrame(
        [("B0", f"P{i % 4}", "AB"[i % 2], "S1", DAY, NOON + timedelta(hours=i)) for i in range(9)]
        + [("B1", "P1", "A", "S2", DAY, NOON), ("B2", "P1", "A", "S2", DAY, None), (None, "P9", "A", "S1", DAY, NOON)],
        PRODUCTION,
    )
    got = silver.quality_metrics(inspections, made, late_reference=reference, hot_key_rows=hot)
    wanted = (
        inspections.join(made, "batch_id")
        .where(fn.delay_hours(F.col("inspection_timestamp"), F.col(reference)) <= 24)
        .groupBy("production_line", "shift_id", "batch_id", "production_date")
        .agg(F.sum("defect_found").alias("d"), F.count("inspection_id").alias("n"))
        .withColumn("r", F.coalesce(F.round(F.try_divide("d", "n") * 100, 2), F.lit(0.0)))
    )
    assert rows(got) == rows(wanted) and rows(got)


def test_defects_by_category_counts_like_the_row_level_join(spark):
    quality = spark.createDataFrame(
        [("A", "S1", f"B{i % 4}", DAY + timedelta(days=i % 3), i % 3, 4, 0.0) for i in range(12)]
        + [("A", "S1", "none", DAY, 1, 2, 50.0), ("A", "S2", None, DAY, 0, 0, 0.0), ("B", "S2", "B1", DAY, None, 5, 0.0)],
        QUALITY,
    )
    made = spark.createDataFrame(
        [(f"B{i % 4}", f"P{i % 3}", "A", "S1", DAY, NOON) for i in range(20)] + [("B3", None, "A", "S1", DAY, NOON)],
        PRODUCTION,
    )
    products = spark.createDataFrame(
        [("P0", "x"), ("P1", "y"), ("P1", "z"), ("P1", "z")], "product_id string, product_category string"
    )
    got = metrics.defects_by_category(quality, made, products).select(
        "production_line", "shift_id", "product_category", "production_date", "total_defects", "total_units"
    )
    wanted = (
        joins.quality_with_product(quality, made, products)
        .groupBy("production_line", "shift_id", "product_category", "production_date")
        .agg(F.sum("defect_count"), F.sum("total_inspected"))
    )
    assert rows(got) == rows(wanted)
    empty = metrics.defects_by_category(quality, made, products).where("shift_id = 'S2' and production_line = 'A'")
    assert empty.first()["daily_defect_rate"] == 0.0


def log(spark, *data):
    return spark.createDataFrame([(m, NOON, kind, minutes, "A", "S1") for m, kind, minutes in data], LOG)


def test_only_downtime_types_count(spark):
    df = log(spark, ("M1", "running", 50), ("M2", "idle", 10), ("M2", "coffee", 99), ("M2", None, 99), ("M2", "running", 7))
    assert rows(silver.downtime_metrics(df)) == [("M2", "A", "S1", 0, 0, 0, 10, 10, 97.92)]


def test_unknown_duration_alone(spark):
    assert rows(silver.downtime_metrics(log(spark, ("M", "idle", None)))) == [
        ("M", "A", "S1", 0, 0, 0, None, None, None)
    ]


def test_availability_is_not_clamped(spark):
    df = log(spark, ("M", "changeover", 480), ("M", "planned_maintenance", 480))
    assert rows(silver.downtime_metrics(df)) == [("M", "A", "S1", 480, 0, 480, 0, 960, -100.0)]


def test_types_add_up(spark, testdata):
    import standins

    result = silver.downtime_metrics(standins.load(spark, testdata, "machine_logs"), by_date="event_ts")
    parts = F.col("planned_maint_mins") + F.col("unplanned_breakdown_mins") + F.col("changeover_mins") + F.col("idle_mins")
    assert result.count() > 0 and result.where(parts != F.col("total_downtime_mins")).isEmpty()


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "x int, y string")
    assert rows(distinct_rows(df)) == [(1, "a"), (1, "b"), (None, None)]
    assert rows(distinct_stats(df)) == [(5, 3, 2)]
    assert rows(distinct_stats(df.limit(0))) == [(0, 0, 0)]


def test_distinct_rows_counted(spark, tmp_path):
    from pyspark.sql import Observation

    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, None)], "x int, y string")
    for index, source in enumerate((df, df.limit(0))):
        seen = Observation()
        distinct_rows_counted(source, seen).write.parquet(str(tmp_path / str(index)))
        assert seen.get == [{"rows_read": 5, "rows_kept": 3}, {"rows_read": 0, "rows_kept": 0}][index]


def test_stamp_appends(spark):
    df = spark.range(2)
    assert stamp(df).columns == ["id", "ingestion_timestamp"]
    assert {r[1] for r in stamp(df, NOON).collect()} == {NOON}


def _defect_days(spark, days):
    quality = spark.createDataFrame(
        [("A", "S1", f"B{i}", DAY + timedelta(days=d), n, 100, 0.0) for i, (d, n) in enumerate(days)], QUALITY
    )
    made = spark.createDataFrame([(f"B{i}", "P", "A", "S1", DAY, NOON) for i in range(len(days))], PRODUCTION)
    return quality, made


def test_row_frame_reaches_over_a_gap_and_calendar_frame_does_not(spark):
    quality, made = _defect_days(spark, [(0, 10), (10, 20)])
    products = spark.createDataFrame([("P", "c")], "product_id string, product_category string")

    def rolling(**options):
        result = kpis.kpi_defect_rate(quality, made, products, **options)
        result = kpis.in_display_order(result, "kpi_defect_rate")
        return [(r["production_date"], r["rolling_7d_defect_rate"]) for r in result.collect()]

    later = DAY + timedelta(days=10)
    assert rolling() == [(later, 15.0), (DAY, 10.0)]
    assert rolling(calendar_days=7) == [(later, 20.0), (DAY, 10.0)]
    assert rolling(window_rows=1) == [(later, 20.0), (DAY, 10.0)]


def test_missing_product_has_its_own_window(spark):
    quality, made = _defect_days(spark, [(0, 10), (1, 30)])
    products = spark.createDataFrame([("other", "c")], "product_id string, product_category string")
    result = kpis.kpi_defect_rate(quality, made, products).orderBy("production_date", ascending=False).collect()
    assert [(r["product_category"], r["rolling_7d_defect_rate"]) for r in result] == [(None, 20.0), (None, 10.0)]
    assert result[0]["prod_week"] == DAY


MADE = "production_line string, shift_id string, production_date date, units_produced int, start_time timestamp, end_time timestamp"


def test_throughput(spark):
    def made(line, shift, units, hours):
        return (line, shift, DAY, units, NOON, NOON + timedelta(hours=hours))

    df = spark.createDataFrame(
        [made("A", "S1", 100, 0), made("A", "S2", 100, 2), made("A", "S3", 60, 1), made("B", "S1", 200, 4), made("B", "S2", 5, -1)],
        MADE,
    )
    got = {(r[0], r[1]): tuple(r[3:]) for r in kpis.kpi_throughput(df).collect()}
    assert got == {
        ("A", "S1"): (0.0, None, None, 4),
        ("A", "S2"): (50.0, 0.0, None, 2),
        ("A", "S3"): (60.0, 50.0, 20.0, 1),
        ("B", "S1"): (50.0, None, None, 2),
        ("B", "S2"): (0.0, 50.0, -100.0, 4),
    }


def test_boundary_minutes(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 10:00:59' a, timestamp'2024-01-01 10:01:01' b")
    assert df.select(fn.boundary_minutes(F.col("a"), F.col("b"))).first()[0] == 1


def test_week_starts_on_monday(spark):
    df = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-07')) d")
    assert {r[0] for r in df.select(fn.week_start(F.col("d"))).collect()} == {DAY}


def test_material_batches(spark):
    quality = spark.createDataFrame(
        [("A", "S1", b, DAY, 0, 1, r) for b, r in [("B1", 5.0), ("B2", 6.0), ("B3", None), ("B4", 1.0)]], QUALITY
    )
    materials = spark.createDataFrame(
        [("B1", "M1", "S", DAY), ("B2", "M1", "S", DAY + timedelta(days=1)), ("B2", "M2", "S", DAY + timedelta(days=1)),
         ("B3", "M1", "S", DAY + timedelta(days=2)), ("B4", "M1", "S", None), ("B9", "M1", "S", DAY)],
        "batch_id string, material_id string, supplier_id string, received_date date",
    )
    result = kpis.in_display_order(kpis.kpi_material_batch(materials, quality), "kpi_material_batch_trends")
    got = [tuple(r) for r in result.collect()]
    assert [(r[0], r[1], r[5], r[6]) for r in got] == [
        ("B3", "M1", False, 17 / 3),
        ("B2", "M1", True, 5.0),
        ("B2", "M2", True, 5.5),
        ("B1", "M1", False, None),
        ("B4", "M1", False, 17 / 3),
    ]


def test_downtime_running_total(spark):
    downtime = silver.downtime_metrics(
        spark.createDataFrame([("M", NOON, "idle", 10, f"L{i:02d}", "S1") for i in range(40)], LOG)
    )
    got = kpis.kpi_downtime(downtime, as_of=DAY).orderBy("production_line").collect()
    assert [r["cumulative_30d_downtime_mins"] for r in got] == [min(i + 1, 30) * 10 for i in range(40)]
    assert {r["record_date"] for r in got} == {DAY}
    today = kpis.kpi_downtime(downtime).select("record_date", F.current_date().alias("today")).first()
    assert today["record_date"] == today["today"]
