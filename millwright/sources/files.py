"""Readers and writers for the two file formats in use: CSV with a header, and Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    infer: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV with a header row.

    With a schema there is no inference pass over the files, the header names
    are checked against it, and a value that does not parse stops the job
    instead of turning into NULL. `infer=True` takes names and types from the
    files, at the price of one more read.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    if schema is None:
        raise ValueError("pass a schema or infer=True")
    return reader.schema(schema).option("enforceSchema", False).option("mode", mode).csv(path)


def read_csv_with_rejects(spark: SparkSession, path: str, schema: StructType, rejected: str) -> DataFrame:
    """CSV with a header row whose names are checked; a row that does not parse keeps its text in the column `rejected`.

    Rows that parse have NULL there. All columns are parsed whatever is selected,
    so the same rows are rejected in every query.
    """
    told = StructType([*schema.fields, StructField(rejected, StringType())])
    reader = spark.read.option("header", True).schema(told).option("enforceSchema", False).option("columnPruning", False)
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", rejected).csv(path)


def reject_reason(raw: Column, schema: StructType) -> Column:
    """Why the text of a row does not parse: the columns whose values do not fit, or too few or too many values."""
    as_text = ", ".join(f"`{f.name}` string" for f in schema.fields)
    values = F.from_csv(raw, as_text, {"mode": "PERMISSIVE"})
    unfit = [
        F.when(values[f.name].isNotNull() & values[f.name].try_cast(f.dataType).isNull(), F.lit(f.name)) for f in schema.fields
    ]
    wrong = F.array_compact(F.array(*unfit))
    n_values = F.size(F.split(raw, ",", -1))
    return (
        F.when(F.size(wrong) > 0, F.concat(F.lit("does not fit: "), F.array_join(wrong, ", ")))
        .when(n_values != len(schema.fields), F.concat(n_values.cast("string"), F.lit(f" values for {len(schema.fields)} columns")))
        .otherwise("does not parse")
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# Stored tables stay for long, and take a quarter less disk this way than by Spark's default, in no more time.
CODEC = "zstd"


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


# Rows of a packed file at most: it is read by one task, as it can't be split.
PACKED_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header row, packed by the fastest level of gzip: about a third of the bytes, in the same time."""
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": PACKED_ROWS}
    df.write.option("header", True).options(**packed).csv(path)
