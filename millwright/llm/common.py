"""Small things the operators share: word patterns, reading a table, hash-split batches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millwright.workspace import run_folder

# Fixed values of the result contracts.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def segments(text: bytes, size: int) -> Iterator[bytes]:
    """A text in runs of whole words of about `size` bytes, so that a very long one is never split up at once."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + size)
        stop = space.start() if space else len(text)
        yield text[at:stop]
        at = stop


def free_name(df: DataFrame, name: str) -> str:
    """`name`, or something like it that no column of `df` is called."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def row_key() -> Column:
    """128 bits of doc_id and text: only rows alike in both share a key, whatever else shares the id or has none."""
    text = F.coalesce(F.md5(F.col("text").cast("binary")), F.lit(""))
    return F.unhex(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), text)))


def with_keys(documents: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The documents whose row key is (`left_semi`) or is not (`left_anti`) in the only column of `keys`, with the key as last column."""
    name = free_name(documents, "own_key")
    return documents.withColumn(name, row_key()).join(keys.toDF(name), name, how).select(*[f"`{c}`" for c in documents.columns], name)


def ascii_lower(text: Column) -> Column:
    """A-Z only; the plain `lower` is used where it does the same, as it is much faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """`df` written once as a table bucketed by `key` into the shared folder.

    Later groupings and co-groupings by that key move nothing.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    split = df.repartition(buckets, key)
    (
        split.write.bucketBy(buckets, key).option("compression", "zstd")
        .option("path", f"{run_folder(spark)}/{name}").saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay; the frame has been resolved already
    return table


def blocked(documents: DataFrame, block_bytes: int, together: bool = True) -> tuple[DataFrame, int]:
    """(block, doc_id, text) hash-split by doc_id and text into blocks of about `block_bytes` of text.

    Rows that share an id, or have none, spread over the blocks; rows that share
    the text too do so unless they are to stay `together`. The split is `bucketed`
    by block. The number of blocks follows the input; a block never grows with it.
    """
    total = documents.agg(F.sum(text_bytes(F.col("text")) + 64)).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    # Blocks are dealt to buckets by Spark's own hash, so there are fewer buckets than blocks.
    row = ["doc_id", "text"] if together else ["doc_id", "text", F.monotonically_increasing_id()]
    split = documents.select(F.pmod(F.xxhash64(*row), F.lit(n)).cast("int").alias("block"), "doc_id", "text")
    return bucketed(split, "block", max(1, n // 2)), n
