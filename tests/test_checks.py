"""Data-quality rules at their thresholds."""

from datetime import date, datetime, timedelta

import pytest

from conftest import rows
from millwright.operators import checks

NOON = datetime(2024, 1, 1, 12)


def table(spark, *data):
    return spark.createDataFrame(list(data), "k string, x int, d double")


def test_duplicates_report_all_rows_of_repeated_keys(spark):
    df = table(spark, *[(k, 1, None) for k in "aabbbc"], (None, 1, None), (None, 2, None))
    assert rows(checks.duplicate_counts(df, ["k"])) == [(3, 7)]
    assert rows(checks.duplicate_rows(df, ["k"])) == [("a", 2), ("b", 3), (None, 2)]
    assert not checks.check_duplicates(df, ["k"])
    assert checks.check_duplicates(df, ["k"], tolerance=7)
    assert checks.check_duplicates(df.limit(0), ["k"])
    assert checks.check_duplicates(df.dropDuplicates(["k"]), ["k"])


def test_null_share_counts_nan_and_passes_at_the_threshold(spark):
    df = table(spark, ("a", None, float("nan")), ("b", 1, None), ("c", 1, 1.0), ("d", 1, 1.0))
    assert rows(checks.null_shares(df, ["k", "x", "d"], 0.25)) == [
        ("d", 2, 0.5, False), ("k", 0, 0.0, True), ("x", 1, 0.25, True),
    ]
    assert not checks.check_nulls(df, ["k", "d"], 0.25)
    assert checks.check_nulls(df, ["k", "x"], 0.25)
    assert checks.check_nulls(df.limit(0), ["k", "x", "d"], 0.0)


def test_late_events(spark):
    def events(*delays):
        data = [(None if d is None else NOON + d, NOON) for d in delays] + [(NOON, None)]
        return spark.createDataFrame(data, "event timestamp, reference timestamp")

    on_time = events(timedelta(hours=24), timedelta(hours=-900), None)
    late = events(timedelta(hours=24, seconds=1), timedelta(0))
    assert rows(checks.late_events(on_time, "event", "reference")) == [(0, 4, True)]
    assert rows(checks.late_events(late, "event", "reference")) == [(1, 3, False)]
    assert checks.check_late_events(late, "event", "reference", 25)
    as_text = late.selectExpr("cast(event as string) event", "cast(reference as string) reference")
    assert not checks.check_late_events(as_text, "event", "reference")
    assert "delay_hours" not in late.columns


@pytest.mark.parametrize("current,history,passed", [(120, 100, True), (121, 100, False), (80, 100, True), (79, 100, False), (5, 0, True)])
def test_row_count_deviation(current, history, passed):
    assert checks.check_row_count_deviation(current, history) is passed


def test_row_count_deviation_by_period(spark):
    counts = {1: 10, 2: 12, 3: 20}
    df = spark.createDataFrame(
        [(date(2024, 1, day),) for day, n in counts.items() for _ in range(n)], "day date"
    )
    got = checks.row_count_deviation(df, "day").orderBy("day").collect()
    assert [(r["n_rows"], r["historical_avg"], r["passed"]) for r in got] == [
        (10, None, True), (12, 10.0, True), (20, 11.0, False),
    ]


def test_row_count_deviation_of_given_counts(spark):
    df = spark.createDataFrame([(NOON + timedelta(days=i), n) for i, n in enumerate([100, 100, 121])], "run_at timestamp, n int")
    got = checks.row_count_deviation(df, "run_at", counts="n").orderBy("run_at").collect()
    assert [(r["n_rows"], r["historical_avg"], r["passed"]) for r in got] == [
        (100, None, True), (100, 100.0, True), (121, 100.0, False),
    ]


def test_row_count_deviation_of_several_series(spark):
    df = spark.createDataFrame(
        [(name, date(2024, 1, day), n) for name, ns in {"a": [10, 12], "b": [10, 13], "c": [5]}.items() for day, n in enumerate(ns, 1)],
        "name string, day date, n int",
    )
    for period in ("day", "cast(day as timestamp)"):
        by_period = df.selectExpr("name", f"{period} AS day", "n")
        rule = checks.RowCountDeviation("t", "day", counts="n", series="name")
        assert rows(checks.run_checks({"t": by_period}, [rule])) == [
            ("row_count_deviation", "t", "a", 0.2, 0.2, True),
            ("row_count_deviation", "t", "b", 0.3, 0.2, False),
            ("row_count_deviation", "t", "c", None, 0.2, True),
        ]


def test_report(spark):
    tables = {
        "t": table(spark, ("a", None, 1.0), ("a", 1, 1.0)),
        "e": spark.createDataFrame([(NOON + timedelta(days=2), NOON, date(2024, 1, 1))], "event timestamp, ref timestamp, day date"),
    }
    rules = [
        checks.UniqueKeys("t", ("k",)),
        checks.UniqueKeys("t", ("k", "x")),
        checks.NullShare("t", ("x", "d"), 0.4),
        checks.LateEvents("e", "event", "ref"),
        checks.RowCountDeviation("e", "day"),
    ]
    report = checks.run_checks(tables, rules)
    assert tuple(report.columns) == checks.REPORT_COLUMNS
    assert rows(report) == [
        ("duplicates", "t", "k", 2.0, 0.0, False),
        ("duplicates", "t", "k,x", 0.0, 0.0, True),
        ("late_events", "e", "event", 1.0, 0.0, False),
        ("nulls", "t", "d", 0.0, 0.4, True),
        ("nulls", "t", "x", 0.5, 0.4, False),
        ("row_count_deviation", "e", "day", None, 0.2, True),
    ]
    assert not checks.all_passed(report)
    with pytest.raises(ValueError):
        checks.run_checks(tables, [])


def test_row_wise_rules_share_one_scan(spark, testdata):
    df = spark.read.parquet(f"{testdata}/orders.parquet")
    report = checks.run_checks(
        {"o": df},
        [checks.NullShare("o", ("o_orderkey", "o_custkey")), checks.NullShare("o", ("o_totalprice",)),
         checks.LateEvents("o", "o_orderdate", "o_orderdate")],
    )
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
