"""Deliveries day by day against the whole at once."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millwright.operators import frames, joins
from millwright.params import Params
from millwright.plans import daily, kpis, silver, stream
from millwright.schemas import RAW

AS_OF = datetime(2024, 3, 1)
START = datetime(2024, 1, 1)


def _tables(seed, days=range(10)):
    """Rows of all raw tables with the day each belongs to; batches are inspected days after they were made."""
    rng = random.Random(seed)
    production, inspections, logs, materials = [], [], [], []
    for d in days:
        for k in range(3):
            batch, start = f"B{d}-{k}", START + timedelta(days=d, hours=8 * k)
            production.append((batch, f"P{k}", f"L{k % 2}", f"S{k}", 100 * d + k, start.date(), start, start + timedelta(hours=rng.randint(4, 8))))
            for i in range(rng.randint(1, 4)):
                when = start + timedelta(days=rng.choice([0, 0, 1, 4]))
                inspections.append((f"I{batch}-{i}", batch, rng.randint(0, 1), None, 1.5, "X", when))
            materials.append((batch, f"M{k}", f"SP{k % 2}", (start - timedelta(days=rng.randint(0, 3))).date(), "A"))
        for m in range(4):
            logs.append((f"MC{m % 2}", START + timedelta(days=d, hours=m), rng.choice(["idle", "changeover", "running"]), rng.choice([5, 10, None]), "L0", f"S{m % 3}"))
    logs.append(("MC0", None, "idle", 7, "L0", "S1"))
    return {"production_records": production, "inspection_results": inspections, "machine_logs": logs, "material_batches": materials}


def _frames(spark, tables):
    return {name: spark.createDataFrame(some, RAW[name]) for name, some in tables.items()}


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(f"P{k}", f"C{k % 2}") for k in range(2)], "product_id string, product_category string")


@pytest.fixture
def store(tmp_path):
    return daily.Store(Params(str(tmp_path / "raw"), str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "out")))


def _deliveries(seed=1):
    """Three deliveries: days 0 to 3, days 4 to 6 without some rows, and the rest with those and with copies."""
    rng, whole = random.Random(seed), _tables(seed)
    first = _tables(seed, range(4))
    whole_upto_six = _tables(seed, range(7))
    parts = [{}, {}, {}]
    for name, some in whole.items():
        early = [r for r in some if r in first[name]]
        middle = [r for r in some if r in whole_upto_six[name] and r not in early]
        late = [r for r in middle if rng.random() < 0.2]
        kept = [r for r in middle if r not in late]
        parts[0][name], parts[1][name] = early, kept + kept[:2]
        parts[2][name] = [r for r in some if r not in early + kept] + kept[:3]
    return whole, parts


def _whole_results(spark, whole, products):
    t = {name: df.withColumn("ingestion_timestamp", F.lit(AS_OF)) for name, df in _frames(spark, whole).items()}
    quality = silver.quality_metrics(t["inspection_results"], t["production_records"])
    by_day = silver.downtime_metrics(t["machine_logs"], by_date="timestamp")
    return {
        "quality": quality,
        "downtime": silver.downtime_metrics(t["machine_logs"]),
        "kpi_downtime": kpis.kpi_downtime(by_day),
        "kpi_defect_rate": kpis.kpi_defect_rate(quality, t["production_records"], products),
        "kpi_throughput": kpis.kpi_throughput(t["production_records"]),
        "kpi_material_batch_trends": kpis.kpi_material_batch(t["material_batches"], quality),
    }


def test_three_deliveries_equal_the_whole(spark, store, products):
    whole, parts = _deliveries()
    seen = []
    for part in parts:
        seen.append({d.dataset: d for d in daily.land(spark, store, _frames(spark, part), F.lit(AS_OF))})
        daily.refresh(spark, store, products)
    for name, some in whole.items():
        assert sum(s[name].rows_new for s in seen) == len(set(some))
        assert seen[2][name].rows_dropped == 3 and seen[1][name].rows_dropped == 2
    expected = _whole_results(spark, whole, products)
    quality = daily.quality_table(spark, store)
    assert rows(quality.select(expected["quality"].columns)) == rows(expected["quality"])
    assert rows(daily.downtime_totals(spark, store).select(expected["downtime"].columns)) == rows(expected["downtime"])
    for name in kpis.INDICATORS:
        stored = daily.read_periods(spark, store.serving(name))
        assert rows(stored.select(expected[name].columns)) == rows(expected[name]), name


def test_only_touched_days_are_read_and_written(spark, store, products):
    _, parts = _deliveries()
    for part in parts[:2]:
        daily.land(spark, store, _frames(spark, part), F.lit(AS_OF))
        daily.refresh(spark, store, products)
    def files(table, days=None):
        found = daily.read_periods(spark, table, days).select(F.input_file_name()).distinct().collect()
        return {r[0] for r in found}

    before = files(store.silver("downtime"), [date(2024, 1, 2)])
    third = {"machine_logs": [("MC0", START + timedelta(days=6, hours=9), "idle", 60, "L0", "S1")]}
    (landed,) = daily.land(spark, store, _frames(spark, third), F.lit(AS_OF))
    assert landed.periods == (date(2024, 1, 7),)
    text = daily.read_periods(spark, store.bronze("machine_logs"), landed.periods)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*period", text)
    assert len(files(store.bronze("machine_logs"), landed.periods)) < len(files(store.bronze("machine_logs")))
    done = daily.refresh(spark, store, products)
    assert done == {"downtime": [date(2024, 1, 7)]}
    assert files(store.silver("downtime"), [date(2024, 1, 2)]) == before
    # The indicator went on from the tail kept after the first delivery.
    assert daily.refresh_downtime_kpi(spark, store, [date(2024, 1, 7)]) == date(2024, 1, 4)
    assert daily.refresh(spark, store, products) == {}


def test_a_step_that_failed_is_repeated(spark, store, products, monkeypatch):
    _, parts = _deliveries(3)
    daily.land(spark, store, _frames(spark, parts[0]), F.lit(AS_OF))

    def broken(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(daily, "refresh_quality", broken)
        with pytest.raises(OSError):
            daily.refresh(spark, store, products)
    # The same delivery again adds nothing, and what was open still is.
    again = daily.land(spark, store, _frames(spark, parts[0]), F.lit(AS_OF))
    assert all(d.rows_new == 0 for d in again)
    done = daily.refresh(spark, store, products)
    assert set(done) == {"downtime", "quality_metrics"} and None in done["downtime"]
    assert daily.quality_table(spark, store).count() > 0


def test_day_from_files(spark, store, products, tmp_path):
    whole, parts = _deliveries(2)
    for part in parts:
        for name, df in _frames(spark, part).items():
            df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{store.params.raw_path}/{name}.csv")
        landed, _ = daily.run_day(spark, store.params, products, as_of=AS_OF)
        assert {d.dataset for d in landed} == set(RAW)
    expected = _whole_results(spark, whole, products)["kpi_defect_rate"]
    stored = daily.read_periods(spark, store.serving("kpi_defect_rate"))
    assert rows(stored.select(expected.columns)) == rows(expected)


def _files(spark, store, parts):
    """Each delivery as a file of its dataset's folder, in the given order."""
    for part in parts:
        for name, df in _frames(spark, part).items():
            df.coalesce(1).write.mode("append").option("header", True).csv(f"{store.params.raw_path}/{name}")


def test_a_stream_of_files_in_any_order_equals_the_whole(spark, products, tmp_path):
    whole, parts = _deliveries(5)
    expected = _whole_results(spark, whole, products)
    results = []
    for k, order in enumerate(([0, 1, 2], [2, 0, 1])):
        base = tmp_path / str(k)
        store = daily.Store(Params(str(base / "raw"), str(base / "b"), str(base / "s"), str(base / "out")))
        _files(spark, store, [parts[i] for i in order[:2]])
        stream.follow(spark, store, str(base / "checkpoint"), products, as_of=AS_OF, files_per_batch=1)
        _files(spark, store, [parts[order[2]]])
        assert stream.follow(spark, store, str(base / "checkpoint"), products, as_of=AS_OF)
        assert stream.follow(spark, store, str(base / "checkpoint"), products, as_of=AS_OF) == {}
        quality = daily.quality_table(spark, store)
        assert rows(quality.select(expected["quality"].columns)) == rows(expected["quality"])
        stored = daily.read_periods(spark, store.serving("kpi_defect_rate"))
        results.append(rows(stored.select(expected["kpi_defect_rate"].columns)))
    assert results[0] == results[1] == rows(expected["kpi_defect_rate"])


def test_live_downtime_drops_copies_and_what_is_too_late(spark, tmp_path):
    from millwright.schemas import RAW as raw

    def send(number, *logs):
        spark.createDataFrame(logs, raw["machine_logs"]).coalesce(1).write.mode("append").parquet(str(tmp_path / "logs"))
        files = spark.readStream.schema(raw["machine_logs"]).parquet(str(tmp_path / "logs"))
        stream.write_updates(stream.live_downtime(files), str(tmp_path / "updates"), str(tmp_path / "checkpoint"))

    row = ("M", START + timedelta(hours=5), "idle", 10, "L", "S")
    send(0, row, row, ("M", START + timedelta(hours=9), "changeover", 4, "L", "S"))
    send(1, row, ("M", START + timedelta(days=6), "idle", 7, "L", "S"))
    send(2, ("M", START + timedelta(hours=1), "idle", 1000, "L", "S"))  # days behind the watermark
    found = stream.latest(spark, str(tmp_path / "updates"), ["machine_id", "record_date"]).select("record_date", "idle_mins", "total_downtime_mins")
    assert rows(found) == [(date(2024, 1, 1), 10, 14), (date(2024, 1, 7), 7, 7)]


def test_rows_with_one_hash_are_told_apart(spark, monkeypatch):
    """Hashes steer, whole rows decide."""
    monkeypatch.setattr(daily, "row_hash", lambda df: F.lit(1).cast("bigint"))
    schema = "a int, b string, day date"
    day = date(2024, 1, 1)
    landed = spark.createDataFrame([(1, "x", day), (None, "y", day)], schema).withColumns(
        {daily.ROW_HASH: F.lit(1).cast("bigint"), daily.PERIOD: F.col("day")}
    )
    raw = spark.createDataFrame([(1, "x", day), (None, "y", day), (2, "x", day), (2, "x", day), (1, None, None)], schema)
    fresh, seen = daily.fresh_rows(raw, "day", "day", landed)
    assert rows(fresh.select("a", "b", "day")) == [(1, None, None), (2, "x", day)]
    assert (seen.rows_read, seen.rows_new, seen.periods) == (5, 2, (day, None))


def test_carried_frames_equal_the_whole(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), i, rng.randint(0, 9)) for i in range(200)]
    schema, order = "g string, t int, v int", ["t"]
    sums = {"s": lambda w: F.sum("v").over(w.rowsBetween(-5, 0)), "p": lambda w: F.lag("v", 3).over(w)}
    whole = frames.over_preceding(spark.createDataFrame(data, schema), ["g"], order, 5, sums)
    for limit in (1000, 20):
        tail, found = None, []
        for a in range(0, 200, 40):
            done = frames.over_carried(spark.createDataFrame(data[a : a + 40], schema), tail, ["g"], order, 5, sums, group_rows=limit)
            found += rows(done.rows)
            tail = spark.createDataFrame(done.tail.collect(), schema)
            assert tail.groupBy("g").count().agg(F.max("count")).first()[0] <= 5
        assert sorted(map(repr, found)) == sorted(map(repr, rows(whole)))


def test_left_join_with_a_hot_right_side(spark):
    left = spark.createDataFrame([(k, f"l{i}") for i, k in enumerate(["hot", "hot", "cold", "none", None])], "k string, l string")
    right = spark.createDataFrame([("hot", i) for i in range(50)] + [("cold", 1), (None, 2), ("other", 3)], "k string, r int")
    expected = rows(left.join(right, "k", "left"))
    assert len(expected) == 103
    for limit in (1_000_000, 10, 1):
        assert rows(joins.salted_left_join(left, right, "k", ["r"], hot_key_rows=limit)) == expected
    # Even where a share of the hot key holds no row.
    assert rows(joins.salted_left_join(left, right.withColumn("same", F.lit(0)), "k", ["same"], hot_key_rows=10).drop("same")) == expected


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joined_sides_that_grow_are_not_broadcast(spark, tmp_path):
    """A few columns of well packed files look small."""
    schema = "batch_id long, product_id long, material_id long, supplier_id long, received_date date, defect_rate double, day date"
    spark.range(100).selectExpr(*[f"cast({'null' if 'date' in c or 'day' in c else 'id'} as {c.split()[1]}) as {c.split()[0]}" for c in schema.split(", ")]).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    assert "Broadcast" not in _executed(joins.material_with_quality(t, t))
    assert "Broadcast" not in _executed(silver.metrics_of_batches(
        t.selectExpr("batch_id", "1 as _defects", "1 as _inspected"),
        t.selectExpr("batch_id", "'l' as production_line", "'s' as shift_id", "day as production_date"),
    ))
    hashed = t.withColumn(daily.ROW_HASH, F.xxhash64("batch_id"))
    assert "Broadcast" not in _executed(daily._alike(hashed, hashed, ["batch_id"], "left_anti"))


def test_rows_of_new_periods_are_shuffled_once_to_where_they_are_stored(spark, store, monkeypatch):
    from pyspark.sql import Observation

    monkeypatch.setattr(daily, "SHARE_ROWS", 4)
    data = [(i % 20, None if i % 3 else "x", None if i % 5 == 0 else date(2024, 1, 1 + i % 2)) for i in range(60)]
    raw = spark.createDataFrame(data, "a int, b string, day date").withColumn(daily.PERIOD, F.col("day"))
    counts, seen = {r[0]: r[1] for r in raw.groupBy(daily.PERIOD).count().collect()}, Observation()
    found = daily.distinct_by_period(raw, counts, seen)
    assert rows(found.select("a", "b", "day")) == rows(raw.select("a", "b", "day").distinct())
    assert seen.get["rows_kept"] == len(set(data))
    assert found.where(F.col(daily.ROW_HASH) != daily.row_hash(raw.select("a", "b", "day"))).count() == 0
    assert len(re.findall(r"(?<!Broadcast)Exchange ", _executed(found))) == 1
    daily.write_periods(found, store.bronze("t"), append=True, rebalance=False)
    assert daily.stored_periods(spark, store.bronze("t")) == set(counts)


def test_a_delivery_of_new_and_landed_periods(spark, store):
    """Copies in both, a period of which nothing is new, and rows without a day."""
    days = [None, *[date(2024, 1, d) for d in (1, 2, 3)]]
    frame = lambda some: {"material_batches": spark.createDataFrame(some, RAW["material_batches"])}
    row = lambda k, day: (f"B{k}", "M", "S", day, "A")
    (one,) = daily.land(spark, store, frame([row(0, days[1]), row(0, days[1]), row(1, days[2]), row(9, None)]), F.lit(AS_OF))
    assert (one.rows_read, one.rows_new, one.periods) == (4, 3, (days[1], days[2], None))
    (two,) = daily.land(spark, store, frame([row(0, days[1]), row(2, days[2]), row(1, days[2]), row(9, None), row(3, days[3]), row(3, days[3])]), F.lit(AS_OF))
    assert (two.rows_read, two.rows_new, two.periods) == (6, 2, (days[2], days[3]))
    stored = daily.read_periods(spark, store.bronze("material_batches"))
    assert rows(stored.select("batch_id")) == [("B0",), ("B1",), ("B2",), ("B3",), ("B9",)]
    log = daily.open_periods(spark, store, "refresh").periods
    assert set(log["material_batches"]) == set(days)
