"""Cutting large window groups into chunks must not change a single row."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millwright.operators.frames import over_preceding, total_before, with_rank
from millwright.operators.joins import salted_join
from millwright.workspace import stage

WHOLE = 10**9


def skewed(spark, n, seed, days=6):
    """Half of all rows in one group, a fifth without a group, days that repeat or are unknown."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        group = rng.choice(["hot"] * 5 + [None] * 2 + ["a", "b", "c"])
        day = rng.choice([None, *range(days)])
        data.append((group, day, i, rng.choice([None, 0.0, 1.5, 2.0, 4.25])))
    return stage(spark.createDataFrame(data, "grp string, day int, id int, v double").repartition(5))


@pytest.mark.parametrize("n,limit,depth,seed", [(400, 15, 4, 1), (400, 3, 6, 2), (200, 2, 29, 3), (300, 40, 1, 4), (7, 1, 4, 5)])
def test_frames_in_chunks(spark, n, limit, depth, seed):
    df = skewed(spark, n, seed)
    measures = {
        "mean": lambda w: F.avg("v").over(w.rowsBetween(-depth, -1)),
        "total": lambda w: F.sum("id").over(w.rowsBetween(-depth, 0)),
        "last_id": lambda w: F.lag("id", 1).over(w),
    }
    order = ["day", "id"]
    whole = over_preceding(df, ["grp"], order, depth, measures, group_rows=WHOLE)
    chunked = over_preceding(df, ["grp"], order, depth, measures, group_rows=limit)
    assert rows(chunked) == rows(whole)
    assert chunked.columns == whole.columns


def test_frames_when_everything_ties_but_the_last_key(spark):
    df = stage(spark.range(300).select(F.lit("s").alias("grp"), F.lit(1).alias("day"), F.col("id").cast("int").alias("id")))
    measures = {"before": lambda w: F.collect_list("id").over(w.rowsBetween(-4, -1))}
    got = over_preceding(df, ["grp"], ["day", "id"], 4, measures, group_rows=10).collect()
    assert {r["id"]: r["before"] for r in got} == {i: list(range(max(0, i - 4), i)) for i in range(300)}


def test_frames_when_everything_ties(spark):
    df = stage(spark.range(300).select(F.lit("s").alias("grp"), F.lit(1).alias("day")))
    measures = {"n": lambda w: F.count("day").over(w.rowsBetween(-4, -1))}
    got = over_preceding(df, ["grp"], ["day"], 4, measures, group_rows=10)
    assert sorted(r["n"] for r in got.collect()) == [0, 1, 2, 3, *[4] * 296]


def test_chunks_split_the_hot_group(spark):
    from millwright.operators import frames

    df = skewed(spark, 2000, 9)
    split = frames._split(df, ["grp"], 300, None)
    assert {r["grp"] for r in split.hot.select("grp").distinct().collect()} == {"hot", None}
    assert split.hot.count() == split.hot_rows == 2000 - split.fitting.count()
    chunked = frames._chunked(split, ["grp"], frames._ascending(["day", "id"]), 100)
    sizes = [r["count"] for r in chunked.groupBy("grp", "_chunk").count().collect()]
    assert max(sizes) < 400 and sum(sizes) == split.hot_rows
    assert frames._split(df, ["grp"], 2000, None) is None


def test_tasks_and_files_do_not_grow_with_the_chunks(spark):
    from millwright.operators import frames

    df = stage(spark.range(3000).selectExpr("cast(id % 3 AS string) AS grp", "cast(id AS int) AS id"))
    chunked = frames._chunked(frames._split(df, ["grp"], 10, None), ["grp"], frames._ascending(["id"]), 10)
    assert len(chunked.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunked.groupBy("grp", "_chunk").agg(F.count("*").alias("n"), F.min("id").alias("first"), F.max("id").alias("last")).collect()
    assert max(c["n"] for c in chunks) <= 10 and sum(c["n"] for c in chunks) == 3000
    for group in "012":
        bounds = [(c["first"], c["last"]) for c in sorted(chunks, key=lambda c: c["_chunk"]) if c["grp"] == group]
        assert all(last < first for (_, last), (first, _) in zip(bounds, bounds[1:]))


@pytest.mark.parametrize("n,limit,seed", [(400, 10, 1), (400, 3, 2), (50, 1, 3)])
def test_rank_in_chunks(spark, n, limit, seed):
    df = skewed(spark, n, seed).withColumn("v", F.col("v") + F.col("id") % 40)
    whole = with_rank(df, ["grp"], "v", "place", group_rows=WHOLE)
    chunked = with_rank(df, ["grp"], "v", "place", group_rows=limit)
    assert rows(chunked) == rows(whole)
    assert chunked.schema["place"].dataType == whole.schema["place"].dataType


def test_rank_with_nothing_but_ties(spark):
    df = stage(spark.range(100).select(F.lit("d").alias("grp"), F.lit(2.0).alias("v"), "id"))
    assert {r["place"] for r in with_rank(df, ["grp"], "v", "place", group_rows=5).collect()} == {1}


def test_empty_input(spark):
    df = skewed(spark, 5, 1).limit(0)
    assert over_preceding(df, ["grp"], ["id"], 2, {"p": lambda w: F.lag("id", 1).over(w)}).collect() == []
    assert with_rank(df, ["grp"], "v", "place").collect() == []


@pytest.mark.parametrize("hot", [1, 7, 60, WHOLE])
def test_salted_join(spark, hot):
    many = skewed(spark, 300, 11)
    one = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), ("zzz", 4), (None, 5)], "grp string, extra int")
    got = salted_join(many, one, "grp", ["id"], hot_key_rows=hot)
    wanted = many.join(one, "grp")
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted)


def test_hot_keys_are_found_and_spread(spark, monkeypatch):
    from millwright.operators import joins

    many = stage(spark.range(60_000).selectExpr("IF(id % 3 = 0, 7, id) AS k", "id"))
    one = spark.range(60_000).withColumnRenamed("id", "k")
    found = []
    original = joins.stage_counted
    monkeypatch.setattr(joins, "stage_counted", lambda df: found.append(original(df)) or found[-1])
    got = salted_join(many, one, "k", ["id"], hot_key_rows=2_000)
    (hot, n_hot), = found
    assert n_hot == 1 and hot.first()["k"] == 7 and 8 <= hot.first()["_salts"] <= 12
    assert got.count() == 60_000 and got.where("k = 7").count() == 20_001


def test_salted_join_without_broadcast(spark, monkeypatch):
    from millwright.operators import joins

    monkeypatch.setattr(joins, "BROADCAST_KEYS", 0)
    many = skewed(spark, 200, 12)
    one = spark.createDataFrame([("hot", 1), ("a", 3)], "grp string, extra int")
    assert rows(salted_join(many, one, "grp", ["id"], hot_key_rows=5)) == rows(many.join(one, "grp"))


@pytest.mark.parametrize("group", [["grp"], []])
@pytest.mark.parametrize("n,limit,seed", [(400, 9, 1), (60, 1, 2)])
def test_totals_in_chunks(spark, group, n, limit, seed):
    df = skewed(spark, n, seed)
    order = [F.col("day").desc_nulls_last(), F.col("id").asc()]
    totals = {"ids": "id", "values": "v"}
    whole = total_before(df, group, order, totals, group_rows=WHOLE)
    chunked = total_before(df, group, order, totals, group_rows=limit)
    assert rows(chunked.select(whole.columns)) == rows(whole)
