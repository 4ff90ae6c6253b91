"""Resharding with the fewest moved bytes, by minimum-cost flow over shards.

Documents are hash-split into blocks inside their old shard; rows that are alike
are numbered, so that any number of them spreads over the blocks. Sizes of blocks
(a bounded list) decide; a minimum-cost flow from old shards to new capacities
says how many bytes go where, blocks that fit best are moved, and only shards
whose content changes are written again. Planning works on narrow rows; the text is
shuffled once, to join its plan row. `shard_plan` plans, `reshard` also writes
shards and tells what is in them.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millwright.workspace import run_folder, stage

from .common import text_bytes

SHARDS = 8
BLOCKS_PER_SHARD = 2048
BLOCK_BYTES = 1 << 27  # above this, blocks get more instead of larger
CHUNKS = 256  # of a group of rows alike, which are numbered chunk by chunk


def min_cost_flow(supply: list[int], capacity: list[int], cost: Callable[[int, int], int]) -> dict[tuple[int, int], int]:
    """Cheapest flow (from, to) -> bytes that ships all supply into the capacities.

    Successive shortest paths on the graph source - old shards - new shards -
    sink; the graph has one node per shard.
    """
    n, m = len(supply), len(capacity)
    source, sink = n + m, n + m + 1
    left = defaultdict(int)
    price = {}

    def edge(a: int, b: int, room: int, each: int) -> None:
        left[a, b], price[a, b], price[b, a] = room, each, -each

    for i, s in enumerate(supply):
        edge(source, i, s, 0)
        for j in range(m):
            edge(i, n + j, s, cost(i, j))
    for j, c in enumerate(capacity):
        edge(n + j, sink, c, 0)
    while True:
        best, via = {source: 0}, {}
        for _ in range(n + m + 2):
            changed = False
            for (a, b), each in price.items():
                if left[a, b] > 0 and a in best and best[a] + each < best.get(b, 1 << 62):
                    best[b], via[b], changed = best[a] + each, a, True
            if not changed:
                break
        if sink not in best:
            return {(i, j): left[n + j, i] for i in range(n) for j in range(m) if left[n + j, i] > 0}
        path, at = [], sink
        while at != source:
            path.append((via[at], at))
            at = via[at]
        amount = min(left[e] for e in path)
        for a, b in path:
            left[a, b] -= amount
            left[b, a] += amount


def block_moves(blocks: list[tuple[int, int, int]], shards: int) -> dict[tuple[int, int], int]:
    """(old shard, block) -> new shard, from (old shard, block, bytes).

    Old shards beyond the new number lose all blocks. Others part with the
    largest blocks that still fit into the flow.
    """
    old = max([shards - 1, *(b[0] for b in blocks)]) + 1
    supply = [0] * old
    for i, _, size in blocks:
        supply[i] += size
    total = sum(supply)
    capacity = [total * (j + 1) // shards - total * j // shards for j in range(shards)]
    flow = min_cost_flow(supply, capacity, lambda i, j: int(i != j))
    wanted = {(i, j): f for (i, j), f in flow.items() if i != j}
    moves = {}

    def move(largest_first: bool, overshoot: int) -> None:
        for i, block, size in sorted(blocks, key=lambda b: (-b[2] if largest_first else b[2], b[0], b[1])):
            if moves.get((i, block), i) != i:
                continue
            most, j = max(((f, -j) for (k, j), f in wanted.items() if k == i), default=(0, 0))
            moves[i, block] = i if i < shards else i % shards
            if 0 < size < most * overshoot or i >= shards and most:
                wanted[i, -j] -= size
                moves[i, block] = -j

    move(True, 1)
    move(False, 2)  # what is left is rounded by the smallest blocks
    return moves


PLAN = ("doc_id", "size", "text_crc32", "old_shard", "shard", "slot")
# Columns of a written shard that replace those of the input.
PLACE = ("old_shard", "shard", "slot")
# Where a row lies: its file and its place in it, the same whenever it is read.
ROW = ("_file", "_place")


def _crc() -> Column:
    return F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("bigint")


def _measured(documents: DataFrame, old_shard: Column, *carry: Column) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, and what is carried along."""
    size = (text_bytes(F.col("text")) + 1).alias("size")
    return documents.select("doc_id", size, _crc().alias("text_crc32"), old_shard.cast("int").alias("old_shard"), *carry)


def _row(documents: DataFrame) -> list[Column]:
    of = documents.metadataColumn("_metadata")
    return [of["file_path"].alias(ROW[0]), of["row_index"].alias(ROW[1])]


def _stored(documents: DataFrame) -> DataFrame:
    """The documents as a table of files, so that each row can be told from any other."""
    try:
        documents.select(*_row(documents))
    except AnalysisException:
        return stage(documents)
    return documents


def _numbered(sized: DataFrame) -> DataFrame:
    """The rows with `nth`, from 0 without gaps among rows alike in doc_id, crc, size and old shard.

    Counted by chunks of such a group first, so no task holds a large one whole.
    """
    alike = ["doc_id", "text_crc32", "size", "old_shard"]
    chunked = sized.withColumn("_chunk", F.pmod(F.xxhash64(*ROW), F.lit(CHUNKS)))
    counts = chunked.groupBy(*alike, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*alike).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_of_{c}") for c in [*alike, "_chunk"]], F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = W.partitionBy(*alike, "_chunk").orderBy(*ROW)
    within = chunked.withColumn("_within", F.row_number().over(inside) - 1)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*alike, "_chunk"]]
    return within.join(offsets, same).select(*sized.columns, (F.col("_before") + F.col("_within")).alias("nth"))


def _block(per_shard: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text_crc32", "nth"), F.lit(per_shard)).cast("int")


def _placed(numbered: DataFrame, shards: int) -> tuple[int, list[tuple[int, int, int, int]]]:
    """Blocks an old shard has, and (old shard, block, new shard, first slot) of every block."""
    old_sizes = numbered.groupBy("old_shard").agg(F.sum("size").alias("bytes"))
    largest = old_sizes.agg(F.max("bytes")).first()[0] or 0
    per_shard = max(BLOCKS_PER_SHARD, -(-largest // BLOCK_BYTES))
    blocked = numbered.withColumn("block", _block(per_shard))
    # One row per block: so many a shard, or one per 128 MB.
    blocks = blocked.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    moves = block_moves([(b.old_shard, b.block, b.bytes) for b in blocks], shards)
    next_slot, placed = [0] * shards, []
    for b in sorted(blocks, key=lambda b: (b.old_shard, b.block)):
        to = moves[b.old_shard, b.block]
        placed.append((b.old_shard, b.block, to, next_slot[to]))
        next_slot[to] += b.n
    return per_shard, placed


def _plan(stored: DataFrame, old_shard: Column, shards: int) -> tuple[DataFrame, list[tuple[int, int, int, int]]]:
    """The plan's columns with where each row lies, as a stored table, and the blocks' places."""
    numbered = stage(_numbered(stage(_measured(stored, old_shard, *_row(stored)))))
    per_shard, placed = _placed(numbered, shards)
    table = stored.sparkSession.createDataFrame(placed, "old_shard int, block int, shard int, first_slot bigint")
    inside = W.partitionBy("old_shard", "block").orderBy("doc_id", "text_crc32", "size", "nth")
    rows = numbered.withColumn("block", _block(per_shard)).withColumn("_inside", F.row_number().over(inside) - 1)
    slotted = rows.join(F.broadcast(table), ["old_shard", "block"])
    slot = (F.col("first_slot") + F.col("_inside")).cast("bigint").alias("slot")
    return stage(slotted.select("doc_id", "size", "text_crc32", "old_shard", "shard", slot, *ROW)), placed


def shard_plan(documents: DataFrame, old_shard: Column, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, shard, slot for each row.

    A null text has no bytes, so size 1 and crc 0. Repeated rows and equal
    texts are rows like any other, and spread like any other. Slots run from 0 in
    each shard without gaps, by block, then by doc_id, crc and size; rows that tie
    in these are alike. Shards are as equal in bytes as whole documents allow; a
    very long one is never split. An empty table gives no rows.
    """
    return _plan(_stored(documents), old_shard, shards)[0].select(*PLAN)


def _write_shards(rows: DataFrame, folder: str) -> None:
    """Rows with shard and slot as `folder`/shard=N, each file in the order of slots."""
    rows.sortWithinPartitions("shard", "slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "shard"
    ).parquet(folder)


def reshard(
    documents: DataFrame, old_shard: Column, shards: int = SHARDS, folder: str | None = None, first: bool = True
) -> DataFrame:
    """The plan of `shard_plan` carried out: the same columns and rows, measured on what was written.

    Shards are written as `folder`/shard=N (by default in the shared folder, until
    the program ends), whole rows with old_shard and slot; columns of these names in
    the input give way. The `first` time `folder` holds no shards, so all are
    written. Later the folder holds the old layout, and only shards that gain or
    lose a row are written again; for the others the result tells the input.
    """
    spark = documents.sparkSession
    stored = _stored(documents)
    plan, placed = _plan(stored, old_shard, shards)
    affected = sorted({s for old, _, new, _ in placed if first or old != new for s in (old, new)})
    if not affected:
        return plan.select(*PLAN)
    # A row's text meets its plan row by where it lies; such keys are never skewed.
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole")
    texts = stored.select(*[c.alias(f"{name}_text") for c, name in zip(_row(stored), ROW)], whole)
    moving = plan.filter(F.col("old_shard").isin(affected))
    joined = moving.join(texts, [F.col(name) == F.col(f"{name}_text") for name in ROW])
    own = [F.col("whole").getField(c).alias(c) for c in documents.columns if c.lower() not in PLACE]
    rows = joined.select(*own, *PLACE)
    folder = folder or f"{run_folder(spark)}/shards_{uuid.uuid4().hex}"
    _write_shards(rows, folder)
    # A new shard has rows of its own only if they moved there, so its old shard is written too.
    written = spark.read.schema(rows.schema).parquet(folder).filter(F.col("shard").isin(affected))
    told = _measured(written, F.col("old_shard"), F.col("shard"), F.col("slot")).select(*PLAN)
    return told.unionByName(plan.filter(~F.col("old_shard").isin(affected)).select(*PLAN))


def rewrite(documents: DataFrame, plan: DataFrame, folder: str, old_shard: Column | None = None) -> list[int]:
    """Write the shards whose content changes, as `folder`/shard=N, and return which they are.

    Shards that neither gain nor lose a document are left as they are on disk.
    Each row follows a plan row of its own: rows find theirs by doc_id, text and,
    if it is given, `old_shard`; of several alike the first takes the first slot.
    Columns old_shard, shard and slot of the input give way to the new ones.
    """
    moved = plan.filter("old_shard <> shard")
    changed = {r[0] for r in moved.select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct().collect()}
    affected = sorted(changed)
    if affected:
        alike = ["doc_id", "text_crc32", "size", *(["old_shard"] if old_shard is not None else [])]
        nth = F.row_number().over(W.partitionBy(*alike).orderBy(F.lit(1)))
        planned = plan.withColumn("nth", F.row_number().over(W.partitionBy(*alike).orderBy("shard", "slot")))
        planned = planned.select(*[F.col(c).alias(f"plan_{c}") for c in [*alike, "nth"]], *PLACE)
        whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("whole")
        rows = _measured(documents, F.lit(0) if old_shard is None else old_shard, whole).withColumn("nth", nth)
        if old_shard is None:
            rows = rows.drop("old_shard")
        else:
            planned = planned.drop("old_shard")
        same = [F.col(c).eqNullSafe(F.col(f"plan_{c}")) for c in [*alike, "nth"]]
        own = [F.col("whole").getField(c).alias(c) for c in documents.columns if c.lower() not in PLACE]
        found = rows.join(planned, same).filter(F.col("shard").isin(affected)).select(*own, *PLACE)
        _write_shards(found.repartition("shard", F.pmod(F.xxhash64("doc_id"), F.lit(64))), folder)
    return affected


def source_shard(shards: int = SHARDS) -> Column:
    """The layout that documents come in: all of a source in one shard; null counts as empty."""
    return F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")) % shards
