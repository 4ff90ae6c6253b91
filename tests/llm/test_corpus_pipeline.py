from __future__ import annotations

import sys
from os.path import dirname

import pytest

sys.path.insert(0, dirname(__file__))
from corpus import documents  # noqa: E402

import corpus_pipeline  # noqa: E402
from __spark_entry__ import oracle_sql, queries  # noqa: E402


def test_stages_take_effect(spark, testdata):
    docs = corpus_pipeline.read_table(spark, testdata, "documents")
    counts, previous = [docs.count()], docs
    for name, function in corpus_pipeline.STAGES[:3]:
        after = corpus_pipeline.stage(function(spark, previous, testdata))
        assert after.columns == docs.columns, name
        assert after.join(previous, "doc_id", "left_anti").count() == 0
        counts.append(after.count())
        previous = after
    assert counts[0] >= counts[1] > counts[2] > counts[3] > 0.6 * counts[0]
    mixed = corpus_pipeline.stage(corpus_pipeline.STAGES[3][1](spark, previous, testdata))
    assert mixed.columns == docs.columns and mixed.join(previous, "doc_id", "left_anti").count() == 0
    words = lambda df: sum(len(r.text.split()) for r in df.select("text").collect())
    assert 1.4 < words(mixed) / words(previous) < 1.6
    sharded = corpus_pipeline.STAGES[4][1](spark, mixed, testdata)
    assert sharded.count() == mixed.count() and {r.shard for r in sharded.select("shard").distinct().collect()} == set(range(8))


def test_awkward_documents_pass(spark, testdata):
    rows = [(1, None), (2, ""), (3, "le eau"), (3, "le eau"), (None, "the and", None, None), (4, "12 34")]
    for at in (documents(spark, rows), documents(spark, [])):
        for _, function in corpus_pipeline.STAGES:
            at = corpus_pipeline.stage(function(spark, at, testdata))
        assert at.columns[0] == "doc_id"


def test_the_shards_stay_when_the_scratch_is_gone(spark, testdata, tmp_path):
    from millwright import workspace

    spark.conf.set(corpus_pipeline.OUTPUT, str(tmp_path / "shards"))
    before, workspace._LEFT = workspace._LEFT, set()
    try:
        told = [tuple(r) for r in corpus_pipeline.run(spark, testdata).collect()]
        workspace._remove_left_folders()
    finally:
        workspace._LEFT = before
        spark.conf.unset(corpus_pipeline.OUTPUT)
    shards = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r[0], r[4], r[5]) for r in told) == sorted((r.doc_id, r.shard, r.slot) for r in shards.collect())
    assert {r.shard for r in shards.select("shard").distinct().collect()} == set(range(8))
    assert {"text", "lang", "source"} <= set(shards.columns) and shards.filter("lang is null").isEmpty()


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.run is queries()["pipeline"]
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in queries() if n.startswith("op")}
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", [n for n in queries() if n.startswith("op") and n not in oracle_sql()])
def test_queries_run(spark, testdata, name):
    assert len(queries()[name](spark, testdata).columns) >= 3
