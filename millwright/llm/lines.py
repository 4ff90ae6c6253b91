"""Repeated lines across documents, from range-partitioned and sorted line hashes.

The lines' 128-bit hashes are range-partitioned by hash, document (largest first)
and line, and every part is walked in that order: `lag` shows where a line or a
document begins, so the first occurrence comes first and the documents of a line
are counted as they pass. A very common line spreads over many parts, as its
documents are part of the range; only the first and last line of a part can go
on in another, and a table of these, two rows a part, joins what the parts have
counted. Documents get the verdicts as bitmaps of 64-line words, of which those
without a dropped line are left out; no text travels before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwright.workspace import stage

from .common import SPACES, ascii_lower

MIN_CHARS = 20
MIN_DOCS = 3
WORD_LINES = 64  # lines of a bitmap word


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_hashes(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h1, h2 (128 bits of the key), doc_id, line_no, of all lines with keys of `min_chars` or more."""
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    keys = lines.select("doc_id", "line_no", line_key(F.col("line")).alias("key"))
    long_enough = keys.filter(F.length("key") >= min_chars)
    return long_enough.select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "line_no"
    )


def _order() -> list[Column]:
    return [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("line_no")]


def ranged_lines(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The line hashes with the number of the range they lie in.

    Ranges are sampled, so the numbered rows are stored: whoever reads them sees the same parts.
    """
    hashes = stage(line_hashes(documents, min_chars))
    parts = max(1, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return stage(hashes.repartitionByRange(parts, *_order()).withColumn("part", F.spark_partition_id()))


def walked(ranged: DataFrame) -> DataFrame:
    """Each row with the number of its line in the part (`run`), the documents that hold it there, and the first of them."""
    in_part = W.partitionBy("part").orderBy(*_order())
    before = F.lag(F.struct("h1", "h2", "doc_id")).over(in_part)
    marked = ranged.withColumn("before", before).withColumn("pos", F.row_number().over(in_part))
    new_line = F.col("before").isNull() | (F.col("before.h1") != F.col("h1")) | (F.col("before.h2") != F.col("h2"))
    new_document = new_line | ~F.col("before.doc_id").eqNullSafe(F.col("doc_id"))
    marked = marked.select("part", "pos", "h1", "h2", "doc_id", "line_no", new_line.cast("long").alias("new_line"), new_document.cast("long").alias("new_document"))
    so_far = W.partitionBy("part").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = marked.withColumn("run", F.sum("new_line").over(so_far))
    whole = W.partitionBy("part", "run").orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    part = W.partitionBy("part").orderBy("run").rangeBetween(W.unboundedPreceding, W.unboundedFollowing)
    return numbered.select(
        "part", "run", "pos", "h1", "h2", "doc_id", "line_no",
        F.sum("new_document").over(whole).alias("docs"), F.first("doc_id").over(whole).alias("first_id"),
        F.max("run").over(part).alias("last_run"),
    )


def _at_edge() -> Column:
    return (F.col("run") == 1) | (F.col("run") == F.col("last_run"))


def joined_edges(edges: DataFrame) -> DataFrame:
    """part, run, all_docs, very_first_id of the lines at the ends of parts, over all parts they reach into.

    A document whose rows lie on both sides of a cut is counted once.
    """
    of_line = W.partitionBy("h1", "h2")
    in_order = of_line.orderBy("part")
    seen_before = F.lag(F.struct("last_id")).over(in_order)
    again = (seen_before.isNotNull() & seen_before["last_id"].eqNullSafe(F.col("first_id"))).cast("long")
    counted = edges.withColumn("again", again)
    every = in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return counted.select(
        "part", "run", F.sum(F.col("docs") - F.col("again")).over(every).alias("all_docs"),
        F.first("first_id").over(every).alias("very_first_id"),
    )


def dropped_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, line_no of the lines to drop: the line is in `min_docs` documents, and not the last of them."""
    told = stage(walked(ranged_lines(documents, min_chars)).filter(_at_edge() | (F.col("docs") >= min_docs)))
    edges = told.filter(_at_edge()).groupBy("part", "run").agg(
        F.first("h1").alias("h1"), F.first("h2").alias("h2"), F.first("docs").alias("docs"),
        F.min_by("doc_id", "pos").alias("first_id"), F.max_by("doc_id", "pos").alias("last_id"),
    )
    ends = joined_edges(edges)  # at most two rows a part
    known = told.join(F.broadcast(ends), ["part", "run"], "left")
    is_edge = F.col("all_docs").isNotNull()
    docs = F.when(is_edge, F.col("all_docs")).otherwise(F.col("docs"))
    first = F.when(is_edge, F.col("very_first_id")).otherwise(F.col("first_id"))
    return known.filter((docs >= min_docs) & ~F.col("doc_id").eqNullSafe(first)).select("doc_id", "line_no")


def drop_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, dropped (array of word, bits; by word), for documents that lose lines.

    Bit i of word w stands for line 64 * w + i. All other lines are kept.
    """
    found = dropped_lines(documents, min_chars, min_docs)
    bit = F.expr(f"shiftleft(1L, line_no % {WORD_LINES})")
    words = found.groupBy("doc_id", F.expr(f"line_no div {WORD_LINES}").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))


def _kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines whose bits are not set; the words are laid out with the absent ones as zeros."""
    def gap(word: Column, i: Column) -> Column:
        behind = F.coalesce(F.get(dropped, i - 1)["word"], F.lit(-1).cast("bigint"))
        return F.concat(F.array_repeat(F.lit(0).cast("bigint"), (word["word"] - behind - 1).cast("int")), F.array(word["bits"]))

    def kept(words: Column) -> Column:
        def is_kept(_: Column, i: Column) -> Column:
            bits = F.coalesce(F.get(words, F.floor(i / WORD_LINES).cast("int")), F.lit(0).cast("bigint"))
            return F.getbit(bits, i % WORD_LINES) == 0

        return F.filter(lines, is_kept)

    return F.element_at(F.transform(F.array(F.flatten(F.transform(dropped, gap))), kept), 1)


def dedup_lines(documents: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, dropped (as in `drop_bitmaps`), kept_text for each row.

    A null or empty text is one empty line; very long texts are split into lines
    whole. Rows that share a doc_id are one
    document when documents are counted, and all lose the same line numbers of it. A null
    doc_id is the smallest id and counts as a document. Ties cannot occur: the
    largest doc_id keeps all its lines. Empty tables give no rows. Only doc_id
    and text are read.
    """
    narrow = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    bitmaps = drop_bitmaps(narrow, min_chars, min_docs).withColumnRenamed("doc_id", "lossy_id")
    joined = narrow.join(bitmaps, F.col("doc_id").eqNullSafe(F.col("lossy_id")), "left").drop("lossy_id")
    none = F.array().cast("array<struct<word:bigint,bits:bigint>>")
    full = joined.select("doc_id", "text", F.coalesce("dropped", none).alias("dropped"))

    def result(lines: Column) -> Column:
        kept = F.transform(F.array(_kept_lines(lines, F.col("dropped"))), lambda x: F.struct(
            (F.size(lines) - F.size(x)).cast("bigint").alias("n_dropped"), F.array_join(x, "\n").alias("kept_text")
        ))
        return F.struct(F.size(lines).cast("bigint").alias("n_lines"), F.element_at(kept, 1).alias("rest"))

    def untouched(lines: Column) -> Column:
        rest = F.struct(F.lit(0).cast("bigint").alias("n_dropped"), F.col("text").alias("kept_text"))
        return F.struct(F.size(lines).cast("bigint").alias("n_lines"), rest.alias("rest"))

    split = F.array(F.split("text", "\n"))
    told = F.when(F.size("dropped") == 0, F.element_at(F.transform(split, untouched), 1)).otherwise(
        F.element_at(F.transform(split, result), 1)
    )
    rows = full.withColumn("told", told)
    return rows.select("doc_id", "told.n_lines", "told.rest.n_dropped", "dropped", "told.rest.kept_text")
