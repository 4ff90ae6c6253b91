"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, components.

Close fingerprints (at most `distance` differing bits) agree on at least two of
`distance + 2` blocks of bits, so they meet under the key of some pair of blocks
and are then verified bit by bit. Only distinct fingerprints meet; copies are
folded before. A key under which more than `BUCKET` fingerprints meet is split
again by pairs of blocks of its remaining bits, until it is small: the bits that
are left shrink with every split, so this ends.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from millwright.workspace import stage, stage_counted

from .common import row_key, segments, with_keys

SEED = 42
BUCKET = 2048
SEGMENT = 1 << 19


def _shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], "<u8")
    ends = list(accumulate(len(w) + 1 for w in words))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[shingle - 1 :])], "<u8")


def simhash(text: bytes | None, shingle: int) -> int:
    """The fingerprint as a signed number; long texts are worked off in segments that share their edges' words."""
    ones, total, words = np.zeros(64, np.int64), 0, []
    for segment in segments((text or b"").lower(), SEGMENT):
        words += segment.split()
        if len(words) >= shingle:
            hashes = _shingle_hashes(words, shingle)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
            words = words[len(words) - shingle + 1 :]
    if not total:
        if not words:
            return 0
        hashes = _shingle_hashes(words, shingle)
        ones += np.unpackbits(hashes.view(np.uint8), bitorder="little")
        total = 1
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3, *keep: str) -> DataFrame:
    """doc_id, the columns named in `keep`, fp (the 64 bits as a signed long), one row per row."""
    narrow = documents.select("doc_id", *keep, F.col("text").cast("binary").alias("text"))
    names = ["doc_id", *keep, "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, texts = batch.columns
            fps = [simhash(text, shingle) for text in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(fps, pa.int64())], names)

    kinds = [f"{c} {narrow.schema[c].dataType.simpleString()}" for c in names[:-1]]
    return narrow.mapInArrow(run, ", ".join([*kinds, "fp bigint"]))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _pair_masks(bits: list[int], blocks: int) -> list[int]:
    """A mask for every pair of `blocks` near-equal runs of the given bit positions."""
    parts = [bits[i * len(bits) // blocks : (i + 1) * len(bits) // blocks] for i in range(blocks)]
    return [sum(1 << b for b in (*x, *y)) for x, y in combinations(parts, 2)]


def _finer(rest: list[int], distance: int) -> list[int]:
    """Masks over the open bits of which two close fingerprints share at least one."""
    if len(rest) > distance + 2:
        return _pair_masks(rest, distance + 2)
    return [sum(1 << b for b in rest if b not in still_open) for still_open in combinations(rest, distance)]


def _split(rows: DataFrame, mask: Column, masks: list[int]) -> DataFrame:
    """A row under each mask: the bits fixed so far with those of the mask."""
    choices = F.array(*[F.lit(_signed(m)) for m in masks])
    wider = rows.select("fp", F.explode(choices).alias("more"), mask.alias("was"))
    return wider.select("fp", F.col("was").bitwiseOR(F.col("more")).alias("mask")).select(
        "fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    )


def _bucket_links(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch.column(0):
                fps = np.unique(np.asarray(members.values.to_numpy(zero_copy_only=False)))
                bits = fps.view(np.uint64)
                open_ = np.ones(len(fps), bool)
                for i in range(len(fps)):
                    front = [i] if open_[i] else []
                    open_[i] = False
                    while front:  # everything reachable inside this bucket, each by one link
                        at = front.pop()
                        new = np.flatnonzero(open_ & (np.bitwise_count(bits ^ bits[at]) <= distance))
                        open_[new] = False
                        left.append(np.full(len(new), fps[at]))
                        right.append(fps[new])
                        front.extend(new.tolist())
            if left:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (left, right)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return run


def links(fps: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(a, b) between distinct fingerprints, enough of the links to connect all that are linked.

    `fps` has distinct values in `fp`. Inside a bucket a spanning forest stands
    for its links, so a crowd of near copies gives as many rows as members.
    """
    found = []
    keyed = _split(fps, F.lit(0).cast("bigint"), _pair_masks(list(range(64)), distance + 2))
    bucket = max(bucket, 1 << distance)  # that many differ in the last open bits
    while True:
        keyed = stage(keyed)
        sizes = stage(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"))
        here = keyed.join(sizes, ["mask", "key"])
        small = here.filter(F.col("n") <= bucket).groupBy("mask", "key", "n").agg(F.collect_list("fp").alias("fps"))
        pairs = small.filter("n = 2").select(F.col("fps")[0].alias("a"), F.col("fps")[1].alias("b"))
        found.append(pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        crowds = small.filter("n > 2").select("fps")
        found.append(crowds.mapInArrow(_bucket_links(distance), "a bigint, b bigint"))
        if not sizes.filter(F.col("n") > bucket).limit(1).count():
            break
        # The pairs of blocks were cut from fixed positions, so each mask leaves known bits over.
        crowded = here.filter(F.col("n") > bucket).select("fp", "mask")
        masks = [r[0] for r in crowded.select("mask").distinct().collect()]  # at most the masks made so far
        split = []
        for m in masks:
            rest = [b for b in range(64) if not (m >> b) & 1]
            split.append(_split(crowded.filter(F.col("mask") == m), F.col("mask"), _finer(rest, distance)))
        keyed = reduce(DataFrame.unionByName, split).distinct()
    return reduce(DataFrame.unionByName, found).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges reaches.

    Alternates large-star and small-star steps until nothing changes. Every
    step is written to the shared folder, so no lineage builds up.
    """
    now, before = stage(edges.filter("a <> b").select("a", "b")), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        down, _ = stage_counted(down)
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select("b", "m").unionByName(least.select(F.col("a").alias("b"), "m"))
        now, n = stage_counted(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        state = (n, now.agg(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[0])
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def near_duplicates(documents: DataFrame, shingle: int = 3, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id of all that are linked) for every row.

    Null or empty texts have fingerprint zero and link like any other. Repeated
    rows are members like any other and come back once each. A null doc_id is a
    member too but never a component_id, unless all of its component are null.
    An empty table gives no rows. Other columns are not looked at.
    """
    prints = stage(fingerprints(documents, shingle))
    # One row per distinct fingerprint: copies are folded before the shuffle.
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    rooted = _rooted(distinct, distance, bucket)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(distinct: DataFrame, distance: int, bucket: int = BUCKET) -> DataFrame:
    """The distinct fingerprints with the root of their component."""
    roots = components(links(distinct.select("fp"), distance, bucket))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def one_per_component(documents: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component: that of the smallest doc_id, null last, and of several texts under that id always the same.

    Rows are told apart by doc_id and text together, so components whose ids are
    null or shared keep a row each. Rows alike in both are repeated rows; one stays.
    """
    keyed = documents.select("doc_id", "text", row_key().alias("key"))
    prints = stage(fingerprints(keyed, shingle, "key"))
    row = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    distinct = stage(prints.groupBy("fp").agg(F.min(row).alias("least_row")))
    kept = _rooted(distinct, distance).groupBy("root").agg(F.min("least_row")["key"].alias("key")).select("key")
    found = with_keys(documents, kept, "left_semi")
    return found.dropDuplicates([found.columns[-1]]).select(*[f"`{c}`" for c in documents.columns])


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
