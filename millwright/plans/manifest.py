"""What each step wrote and from what, so that a later step can tell whether it still holds.

Beside the tables of a layer lies one small entry per table: a fingerprint of
its rows, one of its files, the fingerprints of the tables it was made from, and
counts that checks ask for. The rows' fingerprint and the counts are taken while
they are written, without another scan; the files are listed. An entry that no longer fits its files, or names
inputs that have been written anew since, makes its table stale.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millwright.sources import read_parquet, write_parquet

MANIFEST = "manifest"
_SCHEMA = "table string, n_rows bigint, content string, files string, made_from map<string,string>, counts map<string,bigint>"


class StaleTableError(RuntimeError):
    """A table is not what its step wrote, or was made from tables that have changed since."""


@dataclass(frozen=True)
class Entry:
    table: str
    rows: int
    content: str
    files: str
    made_from: Mapping[str, str] = field(default_factory=dict)
    counts: Mapping[str, int] = field(default_factory=dict)

    @property
    def mark(self) -> tuple[str, str, str]:
        return self.table, self.content, self.files


def _row_bits(df: DataFrame) -> list[Column]:
    """Two hashes of a row. NULL flags are hashed too, since a hash passes over NULLs."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    every = [*columns, *[c.isNull() for c in columns]]
    return [F.xxhash64(*every), F.xxhash64(F.lit("second"), *every)]


def _of_bits(first: Column, second: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bit_xor(first), F.lit(0)).alias("first_bits"),
        F.coalesce(F.bit_xor(second), F.lit(0)).alias("second_bits"),
    ]


def fingerprint(df: DataFrame) -> list[Column]:
    """Aggregates over all rows that do not depend on their order: a count and 128 bits."""
    return _of_bits(*_row_bits(df))


def content_of(observed: Mapping[str, int]) -> str:
    halves = (observed["first_bits"] % (1 << 64), observed["second_bits"] % (1 << 64))
    return f"{observed['rows']}:{halves[0]:016x}{halves[1]:016x}"


def file_fingerprints(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, str]:
    """Per table one string that changes with every name, length and time of its files; contents are not read."""
    def listed(table: str, path: str) -> DataFrame:
        files = (
            spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true").load(path)
        )
        bits = F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0))
        return files.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("n"), bits.alias("bits"))

    if not paths:
        return {}
    found = reduce(DataFrame.unionByName, [listed(*item) for item in paths.items()]).collect()  # a row per table
    return {row["table"]: f"{row['n']}:{row['bits'] % (1 << 64):016x}" for row in found}


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def write_recorded(
    df: DataFrame,
    layer: str,
    table: str,
    made_from: Mapping[str, str] | None = None,
    counts: Mapping[str, Column] | None = None,
) -> Entry:
    """Write a table of a layer and its entry, with the named counts over its rows.

    The old entry goes first: a table whose writing breaks off has none. The hashes are
    columns below the observation, which takes longer to hash a row by itself.
    """
    spark, path, seen, counts = df.sparkSession, f"{layer}/{table}", Observation(), dict(counts or {})
    remove(spark, f"{layer}/{MANIFEST}/{table}")
    asked = [value.alias(f"count_{i}") for i, value in enumerate(counts.values())]
    bits = [f"{half}_{uuid.uuid4().hex}" for half in ("first", "second")]  # the table may have any other names
    hashed = df.withColumns(dict(zip(bits, _row_bits(df))))
    write_parquet(hashed.observe(seen, *_of_bits(*map(F.col, bits)), *asked).drop(*bits), path)
    observed = seen.get
    files = file_fingerprints(spark, {table: path})[table]
    told = {name: observed[f"count_{i}"] for i, name in enumerate(counts)}
    entry = Entry(table, observed["rows"], content_of(observed), files, dict(made_from or {}), told)
    row = [(entry.table, entry.rows, entry.content, entry.files, entry.made_from, entry.counts)]
    write_parquet(spark.createDataFrame(row, _SCHEMA).coalesce(1), f"{layer}/{MANIFEST}/{table}")
    return entry


def recorded(spark: SparkSession, layer: str, tables: Iterable[str]) -> dict[str, Entry]:
    """The entries of those tables that have one."""
    paths = [p for t in tables if exists(spark, p := f"{layer}/{MANIFEST}/{t}")]
    if not paths:
        return {}
    rows = spark.read.schema(_SCHEMA).parquet(*paths).collect()  # a row per table
    return {r["table"]: Entry(r["table"], r["n_rows"], r["content"], r["files"], r["made_from"], r["counts"]) for r in rows}


def require_current(spark: SparkSession, layers: Mapping[str, str], entries: Mapping[str, Entry]) -> None:
    """An error unless every table (name to layer folder) has an entry that fits its files and its inputs' entries."""
    missing = sorted(set(layers) - set(entries))
    if missing:
        raise StaleTableError(f"no finished step has written {', '.join(missing)}")
    files = file_fingerprints(spark, {table: f"{layer}/{table}" for table, layer in layers.items()})
    changed = sorted(t for t, e in entries.items() if t in files and files[t] != e.files)
    if changed:
        raise StaleTableError(f"{', '.join(changed)} changed after the step that wrote it")
    for table, entry in entries.items():
        old = sorted(t for t, content in entry.made_from.items() if t in entries and entries[t].content != content)
        if old:
            raise StaleTableError(f"{table} was made from another {', '.join(old)}; run its step again")
