"""Mixing sources to target weights with Sainte-Lague apportionment.

Each source is a stream of its documents in a seeded order, cut into blocks of
equally many words: as many words in all sources, but fewer where a source or its
target would make less than `LEAST_BLOCKS` of them. The quotients target /
(1, 3, 5, ... times the words of a block) of all sources, highest first, deal out
the blocks until their words make up the total: a run of them fills each shard,
which gives integer quotas per shard. A source's quota takes its blocks in a
seeded order, at most twice each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwright.workspace import stage

from .common import WORD, free_name, row_key

# Fixed values of the contract.
WEIGHTS = (5, 2, 1)
SEED = 7
BLOCKS = 4096
SHARDS = 8

_OWN, _KEY, _SOURCE = "_mix_own_key", "_mix_key", "_mix_source"

LEAST_BLOCKS = 8  # of the common width that a source and its target make; with fewer it gets its own width,
OWN_BLOCKS = 32  # so that it, or its target if that is less, makes so many


def _seeded(seed: int, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def document_sizes(documents: DataFrame, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size in words, seeded key, chunk (the key's first digits), and the columns to carry."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    keyed = documents.select("doc_id", "source", size.alias("size"), _seeded(seed, F.col("doc_id")).alias("key"), *[c for c in carry if c != "source"])
    return keyed.withColumn("chunk", F.substring("key", 1, 3))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, place, source_size, target: 150% of all words by weight, none above twice its size.

    One row per source from here on. With sources in the order of cap / weight,
    the level that those before leave to the others is highest where capping ends.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("place") % len(weights) + 1)
    placed = sources.withColumn("place", place).withColumn("weight", weight)
    room = F.col("source_size") * 2 / F.col("weight")
    before = W.orderBy("room", "place").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = placed.withColumn("room", room).select(
        "*",
        F.coalesce(F.sum(F.col("source_size") * 2).over(before), F.lit(0)).alias("capped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("gone"),
        F.sum("source_size").over(everything).alias("total"),
        F.sum("weight").over(everything).alias("all_weight"),
    )
    level = F.max((F.col("total") * 1.5 - F.col("capped")) / (F.col("all_weight") - F.col("gone"))).over(everything)
    return ranked.withColumn("level", level).select(
        "source", "place", "source_size", "total",
        F.least(F.col("source_size") * 2.0, F.col("level") * F.col("weight")).alias("target"),
    )


def sized_sources(targets: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The targets with width (words of a block) and n_blocks."""
    common, words = F.expr(f"(3 * total) div (2 * {blocks})"), F.least(F.col("source_size").cast("double"), F.col("target"))
    own = F.floor(words / OWN_BLOCKS).cast("bigint")
    width = F.when(words < LEAST_BLOCKS * common, own).otherwise(common)
    sized = targets.withColumn("width", F.greatest(F.lit(1).cast("bigint"), width))
    return sized.withColumn("n_blocks", F.expr("(source_size + width - 1) div width"))


def block_quotas(targets: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """place, seat, shard, width (words of a block), n_blocks: a row for each block dealt out.

    About `blocks` rows and up to twice `OWN_BLOCKS` for each small source, whatever
    the size of the input. Blocks are dealt while the middle of the next one lies
    within the total; shards are filled one after the other, with equally many
    words. A source has no more seats than twice its blocks.
    """
    sized = sized_sources(targets, blocks).filter(F.col("n_blocks") > 0)
    seats = sized.select("*", F.explode(F.expr("sequence(1L, 2 * n_blocks)")).alias("seat"))
    quotient = F.col("target") / ((2 * F.col("seat") - 1) * F.col("width"))
    highest = W.orderBy(quotient.desc(), "place", "seat").rowsBetween(W.unboundedPreceding, -1)
    ranked = seats.withColumn("dealt", F.coalesce(F.sum("width").over(highest), F.lit(0)))
    chosen = ranked.filter(2 * F.col("dealt") + F.col("width") <= 3 * F.col("total"))
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    in_all = chosen.withColumn("in_all", F.sum("width").over(everything))
    return in_all.select(
        "place", "seat", F.expr(f"cast((dealt * {shards}) div in_all as int)").alias("shard"), "width", "n_blocks"
    )


def block_takes(quotas: DataFrame, seed: int = SEED) -> DataFrame:
    """place, block, times, taken_before: how often each block is taken, and the words taken of those before it.

    One block more than the source has closes the list, for documents that end there.
    """
    dealt = quotas.groupBy("place", "width").agg(F.count(F.lit(1)).alias("quota"), F.max("n_blocks").alias("n_blocks"))
    every = dealt.select("*", F.explode(F.expr("sequence(0L, n_blocks)")).alias("block"))
    closing = F.col("block") == F.col("n_blocks")
    order = W.partitionBy("place").orderBy(closing, _seeded(seed, F.col("place"), F.col("block")), "block")
    counted = every.withColumn("nth", F.row_number().over(order))
    times = F.when(closing, 0).otherwise(F.expr("(quota - nth + n_blocks) div n_blocks"))
    counted = counted.withColumn("times", times)
    earlier = W.partitionBy("place").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    return counted.select(
        "place", "block", "times", F.coalesce(F.sum(F.col("times") * F.col("width")).over(earlier), F.lit(0)).alias("taken_before")
    )


def mix(
    documents: DataFrame, seed: int = SEED, blocks: int = BLOCKS, shards: int = SHARDS, carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row, and the columns to carry.

    Null and empty texts have size 0 and nothing is taken of them; whole texts
    are counted, however long. Null is a source of its own, the last. Repeated rows
    are taken row by row. If documents tie in the seeded order (the same doc_id
    twice), sizes and then carried columns break the tie; rows that tie in all are
    alike in the result. Empty tables give no rows.
    """
    sizes = stage(document_sizes(documents, seed, carry))
    targets = stage(source_targets(sizes))
    takes = stage(block_takes(block_quotas(targets, blocks, shards), seed))

    # Where each document starts in its source's stream: chunks first, then inside a chunk.
    chunks = sizes.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    earlier = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = chunks.select(
        F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("chunk_size").over(earlier), F.lit(0)).alias("offset")
    )
    per_chunk = offsets.join(sized_sources(targets, blocks).drop("n_blocks"), F.col("s").eqNullSafe(F.col("source"))).drop("source", "total")
    inside = W.partitionBy("source", "chunk").orderBy("key", "size", *carry).rowsBetween(W.unboundedPreceding, -1)
    laid = sizes.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    laid = laid.join(per_chunk, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))

    # Words taken of the stream up to the document's end, less those up to its start.
    laid = laid.withColumn("start", F.col("offset") + F.col("before")).withColumn("end", F.col("start") + F.col("size"))

    def upto(rows: DataFrame, at: str) -> DataFrame:
        keyed = rows.withColumn("block", F.expr(f"`{at}` div width"))
        words = F.coalesce(F.col("taken_before") + F.col("times") * (F.col(at) - F.col("block") * F.col("width")), F.lit(0))
        joined = keyed.join(takes, ["place", "block"], "left").withColumn(f"taken_to_{at}", words)
        return joined.drop("block", "times", "taken_before")

    counted = upto(upto(laid, "start"), "end")
    return counted.select(
        "doc_id", "size", "source_size", "target", (F.col("taken_to_end") - F.col("taken_to_start")).cast("bigint").alias("taken"), *carry
    )


def mixed_documents(documents: DataFrame, seed: int = SEED, blocks: int = BLOCKS, shards: int = SHARDS) -> DataFrame:
    """The mix as documents: each row as often as the words taken of it come nearest to, 0 to 2 times.

    Only documents that straddle the edge of a block are rounded. Every row goes by
    its own id, text and source, whatever else shares the id or has none; rows
    alike in these get the same number of copies. Null and empty texts, of which
    nothing is taken, go; very long ones are rows like any other. An empty table
    gives no rows; all columns stay.
    """
    copies, nth = (free_name(documents, n) for n in ("copies", "copy_no"))
    keyed = documents.select("doc_id", "text", "source", row_key().alias("row_key"))
    mixed = mix(keyed, seed, blocks, shards, ("row_key", "source"))
    taken = mixed.groupBy("row_key", "source").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    chosen = taken.select(F.col("row_key").alias(_KEY), F.col("source").alias(_SOURCE), times.alias(copies)).filter(F.col(copies) > 0)
    own = [F.col(f"`{c}`") for c in documents.columns]
    joined = documents.withColumn(_OWN, row_key()).join(
        chosen, (F.col(_OWN) == F.col(_KEY)) & F.col("source").eqNullSafe(F.col(_SOURCE))
    )
    repeated = F.explode(F.array_repeat(F.lit(0), F.col(copies))).alias(nth)
    return joined.select(*own, repeated).drop(nth)
