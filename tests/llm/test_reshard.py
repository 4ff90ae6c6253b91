from __future__ import annotations

import itertools
import sys
import zlib
from os.path import dirname

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import reshard  # noqa: E402


def test_flow_is_cheapest():
    supply, capacity = [5, 1, 3], [3, 3, 3]
    costs = [[0, 4, 1], [2, 0, 3], [1, 1, 0]]
    flow = reshard.min_cost_flow(supply, capacity, lambda i, j: costs[i][j])
    best = min(
        sum(costs[i][j] for i, j in zip([0] * 5 + [1] + [2] * 3, order))
        for order in set(itertools.permutations([0] * 3 + [1] * 3 + [2] * 3))
    )
    assert sum(costs[i][j] * f for (i, j), f in flow.items()) == best
    assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(3)] == supply
    assert [sum(f for (_, j), f in flow.items() if j == k) for k in range(3)] == capacity


def test_plan(spark):
    rows = awkward(21, n=400)
    found = reshard.shard_plan(documents(spark, rows), reshard.source_shard()).collect()
    expected = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == expected
    sizes = [sum(r["size"] for r in found if r.shard == s) for s in range(8)]
    largest = max(r["size"] for r in found)
    assert max(sizes) - min(sizes) <= 2 * largest
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    old = [sum(r["size"] for r in found if r.old_shard == s) for s in range(8)]
    surplus = sum(max(0, x - sum(old) / 8) for x in old)
    moved = sum(r["size"] for r in found if r.shard != r.old_shard)
    assert moved <= surplus + 8 * largest
    again = reshard.shard_plan(documents(spark, rows[::-1]), reshard.source_shard()).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)


def test_fewer_shards(spark):
    rows = [(i, "x" * (i % 17)) for i in range(300)]
    found = reshard.shard_plan(documents(spark, rows), (F.col("doc_id") % 10).cast("int"), shards=4).collect()
    sizes = [sum(r["size"] for r in found if r.shard == s) for s in range(4)]
    assert {r.shard for r in found} == set(range(4)) and max(sizes) - min(sizes) <= 60


def test_rewrites_only_changed_shards(spark, tmp_path):
    df = documents(spark, [(i, "x" * 9) for i in range(64)], clash=False)
    old = F.when(F.col("doc_id") < 16, 0).when(F.col("doc_id") < 40, 1).when(F.col("doc_id") < 48, 2).otherwise(3)
    plan = reshard.shard_plan(df, old, shards=4)
    affected = reshard.rewrite(df, plan, str(tmp_path / "out"))
    assert affected == [1, 2]
    written = spark.read.parquet(str(tmp_path / "out"))
    expected = sorted((r.doc_id, r.shard) for r in plan.collect() if r.shard in affected)
    assert sorted((r.doc_id, r.shard) for r in written.collect()) == expected
    assert reshard.rewrite(df, plan.withColumn("old_shard", F.col("shard")), str(tmp_path / "none")) == []


def test_reshard_writes_what_it_tells(spark, tmp_path):
    rows = awkward(22, n=300)
    df = documents(spark, rows)
    done = reshard.reshard(df, reshard.source_shard(), folder=str(tmp_path / "out"), first=False)
    planned = reshard.shard_plan(df, reshard.source_shard())
    assert sorted(map(tuple, done.collect()), key=str) == sorted(map(tuple, planned.collect()), key=str)
    written = spark.read.parquet(str(tmp_path / "out")).collect()
    moved = planned.filter("shard <> old_shard").collect()
    affected = {s for r in moved for s in (r.shard, r.old_shard)}
    told = lambda found: sorted(((r.shard, r.slot, r.doc_id) for r in found if r.shard in affected), key=str)
    assert moved and told(written) == told(done.collect()) and {r.shard for r in written} <= affected
    texts = [(r.doc_id, r.text, r.source) for r in written] + [(i, t, s) for i, t, _, s in rows if zlib.crc32((s or "").encode()) % 8 not in affected]
    assert sorted(texts, key=str) == sorted(((i, t, s) for i, t, _, s in rows), key=str)
    assert reshard.reshard(documents(spark, []), reshard.source_shard()).collect() == []


def test_rows_alike_follow_their_own_plan_rows(spark, tmp_path):
    """One copy lies in a shard that stays as it is; the others go to two shards."""
    df = documents(spark, [(1, "same", "en", s) for s in "abc"] + [(2, "other", "en", "b")], clash=False)
    old = F.when(F.col("source") == "a", 0).when(F.col("source") == "b", 1).otherwise(2)
    crc = zlib.crc32(b"same"), zlib.crc32(b"other")
    plan = [(1, 5, crc[0], 0, 0, 0), (1, 5, crc[0], 1, 1, 0), (1, 5, crc[0], 2, 2, 0), (2, 6, crc[1], 1, 2, 1)]
    plan = spark.createDataFrame(plan, "doc_id bigint, size bigint, text_crc32 bigint, old_shard int, shard int, slot bigint")
    for name, given in (("with", old), ("without", None)):
        assert reshard.rewrite(df, plan, str(tmp_path / name), given) == [1, 2]
        written = spark.read.parquet(str(tmp_path / name)).collect()
        assert sorted((r.doc_id, r.shard, r.slot) for r in written) == [(1, 1, 0), (1, 2, 0), (2, 2, 1)]
        assert given is None or {(r.source, r.shard) for r in written if r.doc_id == 1} == {("b", 1), ("c", 2)}


@pytest.mark.parametrize("rows", [
    [(1, "x" * 999, "en", "a")] * 3000 + [(i, "y" * 5, "en", "b") for i in range(20)],
    [(None, None, None, None)] * 3000 + [(i, "y" * (i % 9), "en", f"s{i % 5}") for i in range(120)],
])
def test_rows_alike_spread(spark, rows):
    """Shards come within a row of equal bytes however many rows are alike."""
    found = reshard.reshard(documents(spark, rows), reshard.source_shard()).collect()
    sizes = [sum(r["size"] for r in found if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= max(r["size"] for r in found) and len(found) == len(rows)
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_the_first_time_all_shards_are_written(spark, tmp_path):
    """One shard keeps its rows; it is written all the same, and later it is not."""
    df = documents(spark, [(i, "x" * 9) for i in range(64)], clash=False)
    old = F.when(F.col("doc_id") < 16, 0).when(F.col("doc_id") < 40, 1).when(F.col("doc_id") < 48, 2).otherwise(3)
    for first, expected in ((True, {0, 1, 2, 3}), (False, {1, 2})):
        folder = str(tmp_path / str(first))
        done = reshard.reshard(df, old, shards=4, folder=folder, first=first)
        assert done.count() == 64 and {r.shard for r in spark.read.parquet(folder).select("shard").distinct().collect()} == expected


def test_no_rows_and_only_nulls(spark):
    assert reshard.shard_plan(documents(spark, []), reshard.source_shard()).collect() == []
    rows = reshard.shard_plan(documents(spark, [(None, None, None, None)] * 3), reshard.source_shard()).collect()
    assert all((r.doc_id, r["size"], r.text_crc32) == (None, 1, 0) for r in rows) and len(rows) == 3
