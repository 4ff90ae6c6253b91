"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, decontaminate, hpylm, langid, lines, mixing, quality, ranking, repeats, reshard, runs, simhash, urls
from .common import fold, read_table
from .oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = lines.dedup_lines(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge_urls(read_table(spark, folder, "pages"), read_table(spark, folder, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return hpylm.score_documents(read_table(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op6_resharding(spark: SparkSession, folder: str) -> DataFrame:
    done = reshard.reshard(read_table(spark, folder, "documents"), reshard.source_shard())
    return done.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


def op7_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_table(spark, folder, "documents"))


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    found = langid.identify(documents, langid.training_rows(documents))
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, folder, "documents"), shingle=3, distance=3)
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(read_table(spark, folder, "documents"), read_table(spark, folder, "pages"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    # Fixed by the contract: a conversation whose texts hold control strings.
    marked = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", marked), (-7, 1, "assistant", marked)], conversations.schema)
    return chat.read_back(chat.format_conversations(conversations.unionByName(extra)))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents").select("doc_id", runs.with_loops(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.collapse_runs(documents)
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(runs.run_lines(F.col("runs")), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.search(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_line_dedup, op3_url_filters, op4_lm_scoring, op5_decontamination,
        op6_resharding, op7_source_mixing, op8_language_id, op9_simhash, op10_quality_rules,
        op11_chat_formatting, op12_periodic_runs, op13_ranked_search,
    )
}

__all__ = ["ORACLES", "QUERIES"]
