"""Raw CSV to bronze Parquet: read, drop full-row copies, stamp, write.

Rows that do not parse stop the ingest, or are set aside with a reason.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from millwright.operators.rows import distinct_rows, distinct_rows_counted, stamp
from millwright.plans.manifest import remove, write_recorded
from millwright.schemas import RAW
from millwright.sources import read_csv, read_csv_with_rejects, reject_reason, write_parquet
from millwright.workspace import concurrently


@dataclass(frozen=True)
class Ingested:
    dataset: str
    path: str
    rows_read: int
    rows_kept: int
    rows_rejected: int = 0

    @property
    def rows_dropped(self) -> int:
        """Copies."""
        return self.rows_read - self.rows_kept - self.rows_rejected


def bronze_table(raw: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return stamp(distinct_rows(raw), as_of)


Counts = Callable[[DataFrame], Mapping[str, Column]]

QUARANTINE, RAW_TEXT = "quarantine", "raw_text"


def land(
    raw: DataFrame, dataset: str, bronze_path: str, as_of: datetime | None = None, counts: Counts | None = None
) -> Ingested:
    """Write one dataset; the input is read once and shuffled once, fingerprint and counts included."""
    seen = Observation()
    landed = stamp(distinct_rows_counted(raw, seen), as_of)
    write_recorded(landed, bronze_path, dataset, counts=counts(landed) if counts else None)
    return Ingested(dataset, f"{bronze_path}/{dataset}", seen.get["rows_read"], seen.get["rows_kept"])


def land_with_rejects(
    spark: SparkSession, path: str, schema: StructType, dataset: str, bronze_path: str, as_of: datetime | None = None,
    counts: Counts | None = None,
) -> Ingested:
    """`land` a CSV file some rows of which may not parse.

    Those go to `<bronze>/quarantine/<dataset>` with what could be parsed, their text, a
    reason, and how often they occur. Whether there are any is noticed while the
    others are written; only then they are read again and counted.
    """
    noticed, seen, beside = Observation(), Observation(), f"{bronze_path}/{QUARANTINE}/{dataset}"
    raw = read_csv_with_rejects(spark, path, schema, RAW_TEXT)
    is_bad, columns = F.col(RAW_TEXT).isNotNull(), [f.name for f in schema.fields]
    watched = raw.observe(noticed, F.count_if(is_bad).alias("rejected"))
    landed = land(watched.filter(~is_bad).select(*columns), dataset, bronze_path, as_of, counts)
    if not noticed.get["rejected"]:
        remove(spark, beside)
        return landed
    rejects = raw.filter(is_bad).groupBy(*columns, RAW_TEXT).agg(F.count(F.lit(1)).alias("n_rows"))
    told = rejects.withColumn("reason", reject_reason(F.col(RAW_TEXT), schema)).observe(seen, F.sum("n_rows").alias("rows"))
    write_parquet(stamp(told, as_of), beside)
    rejected = seen.get["rows"]
    return replace(landed, rows_read=landed.rows_read + rejected, rows_rejected=rejected)


def ingest(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    *,
    datasets: Iterable[str] | None = None,
    schemas: Mapping[str, StructType] = RAW,
    infer: bool = False,
    as_of: datetime | None = None,
    quarantine: bool = False,
    counts: Mapping[str, Counts] | None = None,
) -> list[Ingested]:
    """Land `<raw_path>/<dataset>.csv` for every dataset, side by side; a failure is raised.

    With `quarantine`, rows that do not parse are set aside instead of failing.
    `counts` says per dataset what is to be counted while it is written.
    """

    def job(name: str) -> Ingested:
        path, counted = f"{raw_path}/{name}.csv", (counts or {}).get(name)
        if quarantine and not infer:
            return land_with_rejects(spark, path, schemas[name], name, bronze_path, as_of, counted)
        return land(read_csv(spark, path, schemas.get(name), infer=infer), name, bronze_path, as_of, counted)

    names = list(schemas if datasets is None else datasets)
    return concurrently(spark, [partial(job, name) for name in names])
