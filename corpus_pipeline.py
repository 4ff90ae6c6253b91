"""A training-data pipeline over `documents`: each stage calls one of the corpus operators.

Every stage works on all that its predecessor kept; its result is written to the
shared folder and read again, so a lost executor repeats one stage at most. The
product are the shards: whole documents as `shard=N` below a folder that stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from millwright.llm import decontaminate, langid, mixing, reshard, simhash
from millwright.llm.common import read_table
from millwright.workspace import scratch, shared_folder, stage, stage_path

# The session setting that names the folder of the shards; without it they go to a new one in the shared folder.
OUTPUT = "millwright.corpus.output"


def output_folder(spark: SparkSession) -> str:
    """Where this run's shards go. Nothing removes them."""
    return spark.conf.get(OUTPUT, None) or f"{shared_folder(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages (no text, or no letter in it) go; a missing `lang` is filled in."""
    return langid.in_known_language(docs, langid.training_rows(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return simhash.one_per_component(docs, shingle=3, distance=3).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, or a paraphrase with its answer, go."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that sources come to their target weights."""
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """From the layout by source to eight shards of equal bytes, moving as few bytes as that takes; all shards are written."""
    return reshard.reshard(docs, reshard.source_shard(), folder=output_folder(spark)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", "old_shard"
    )


STAGES = [
    ("language identification", identify_language),
    ("near-duplicate removal", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
    ("resharding", assign_shards),
]

ORACLE_SQL = None  # profiles, fingerprints and latent spaces have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the `documents` table. What a stage wrote on the way goes when it ends."""
    docs = read_table(spark, sf_dir, "documents")
    for _, function in STAGES:
        path = stage_path(spark)
        with scratch(spark):
            docs = stage(function(spark, docs, sf_dir), path)
    return docs
