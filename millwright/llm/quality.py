"""Quality rules by host: rule failures per host, rates shrunk to an empirical beta prior.

Counts per document come from array functions over the text; no Python runs. A
host with few documents has its failure rate pulled towards that of all hosts,
by a beta prior fitted to the hosts' rates (method of moments), so one bad page
does not condemn a small host. A host is condemned if its rate lies far above what
the prior holds likely. The verdict is joined back to documents. The host of a
document is that of the page it came from, or else its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millwright.workspace import stage

from .common import SPACE_RUN, WORD
from .urls import host_and_path

MIN_WORDS = 50
REPEAT_SHARE = 50  # percent
SPREAD = 3.0  # standard deviations of the prior above its mean, from which on a host fails,
MAX_HOST_RATE = 0.8  # and a rate that is too high for any prior


def _once(value: Column, then) -> Column:
    """`then(value)` with `value` bound to a lambda variable, so that it is computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _word_array(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_RUN), lambda w: w != "")


def _repeat_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more; `windows` has a hash per start."""
    def covered(starts: Column) -> Column:
        # Sorted starts: a window covers three words, less what the next one covers again.
        gaps = F.transform(starts, lambda s, i: F.least(F.lit(3), F.coalesce(F.get(starts, i + 1) - s, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    def repeated(pairs: Column) -> Column:
        def same(p: Column, i: Column) -> Column:
            return F.coalesce(F.get(pairs, i)["h"] == p["h"], F.lit(False))

        kept = F.filter(pairs, lambda p, i: same(p, i - 1) | same(p, i + 1))
        return _once(F.sort_array(F.transform(kept, lambda p: p["at"])), covered)

    def either(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(_once(pairs, repeated))

    return _once(windows, either)


def document_counts(documents: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the contract's counts for each row; a null text has no words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = documents.select("doc_id", F.col(host).alias("host"), text.alias("text"))

    def windows(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - 3)
        hashes = F.transform(starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
        return F.when(F.size(words) < 3, F.lit(0)).otherwise(_repeat_words(hashes))

    has_word = F.filter(F.split(F.col("text"), "\n"), lambda line: line.rlike(WORD))
    return base.select(
        "doc_id",
        "host",
        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        _once(has_word, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _once(_word_array(F.col("text")), windows).cast("bigint").alias("n_repeat_words"),
    )


def with_base_verdict(counts: DataFrame) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    return counts.withColumn("base_failed", failed)


def with_hosts(counts: DataFrame, pages: DataFrame) -> DataFrame:
    """The counts with the host of the page of that id in place of the source, where there is such a page.

    Of several pages with one id the least host by code point counts.
    """
    host, _ = host_and_path(F.col("url"))
    hosts = pages.select(F.col("page_id"), host.alias("page_host")).filter("page_host <> ''")
    hosts = hosts.groupBy("page_id").agg(F.min("page_host").alias("page_host"))
    joined = counts.join(hosts, F.col("doc_id") == F.col("page_id"), "left")
    return joined.withColumn("host", F.coalesce("page_host", "host")).drop("page_id", "page_host")


def host_verdicts(judged: DataFrame, max_rate: float = MAX_HOST_RATE, spread: float = SPREAD) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunk), limit and host_failed, a row per host.

    With mean m and variance v of the hosts' own rates, the prior is
    Beta(m * s, (1 - m) * s), s = m * (1 - m) / v - 1, kept within 1 and 1e6;
    where all hosts agree, or there is one, v is 0 and s is 1e6. The limit is
    m + `spread` * sqrt(m * (1 - m) / (s + 1)), but `max_rate` at most.
    A null host is a host of its own.
    """
    hosts = judged.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("bigint")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(F.avg(rate).alias("m"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("v"))
    strength = F.when(F.col("v") <= 0, F.lit(1e6)).otherwise(
        F.greatest(F.lit(1.0), F.least(F.lit(1e6), F.col("m") * (1 - F.col("m")) / F.col("v") - 1))
    )
    prior = moments.select("m", strength.alias("s"))
    deviation = F.sqrt(F.col("m") * (1 - F.col("m")) / (F.col("s") + 1))
    prior = prior.withColumn("limit", F.least(F.lit(max_rate), F.col("m") + spread * deviation))  # one row
    shrunk = (F.col("n_failed") + F.col("m") * F.col("s")) / (F.col("n_docs") + F.col("s"))
    return (
        hosts.join(F.broadcast(prior))
        .select("host", "n_docs", "n_failed", shrunk.alias("host_rate"), "limit")
        .withColumn("host_failed", F.col("host_rate") > F.col("limit"))
    )


def judge(
    documents: DataFrame, pages: DataFrame | None = None, host: str = "source", max_rate: float = MAX_HOST_RATE, spread: float = SPREAD
) -> DataFrame:
    """The counts, base_failed, host, host_rate and kept, for each row.

    Without `pages`, or for a document that is no page's, `host` names the column
    to take. Empty tables give no rows; repeated rows count as often as they
    occur; a null or empty text has no words and fails; a very long one is counted
    whole; a null doc_id is no page's. Only doc_id, text, `host`, page_id and url are read.
    """
    counts = document_counts(documents, host)
    # Counted once; what is stored holds numbers, no text.
    judged = stage(with_base_verdict(counts if pages is None else with_hosts(counts, pages)))
    hosts = host_verdicts(judged, max_rate, spread).withColumnRenamed("host", "verdict_host")
    joined = judged.join(hosts, F.col("host").eqNullSafe(F.col("verdict_host")), "left")
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~F.coalesce(F.col("host_failed"), F.lit(False))).alias("kept"),
        "host", "host_rate",
    )
