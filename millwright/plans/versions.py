"""A set of published tables that is replaced as a whole or not at all.

All tables of a run are written into a folder of their own. Only when every one
is there does the store turn to it: over a folder one small pointer file is
renamed into place, in the catalog the tables are set to their new locations.
Until then, and whatever fails, readers find the version before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession

from millwright.plans.manifest import exists, remove

POINTER, VERSIONS = "CURRENT", "versions"
KEPT = 2  # versions that stay: the current one, and those before it for readers that still hold them


def _files(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def new_version() -> str:
    """A name; later ones sort after earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def _point(spark: SparkSession, store: str, version: str) -> None:
    """Write the pointer beside the old one and rename it over that."""
    jvm = spark.sparkContext._jvm
    files, pointer = _files(spark, f"{store}/{POINTER}")
    _, draft = _files(spark, f"{store}/.{POINTER}-{version}")
    out = files.create(draft, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(draft, pointer, options)


def current_version(spark: SparkSession, store: str) -> str | None:
    """The version that readers see, or None before the first."""
    path = f"{store}/{POINTER}"
    return spark.read.text(path).first()[0] if exists(spark, path) else None


def version_folder(store: str, version: str) -> str:
    return f"{store.rstrip('/')}/{VERSIONS}/{version}"


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in a folder, sorted; nothing if there is none."""
    files, folder = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def versions(spark: SparkSession, store: str) -> list[str]:
    """All versions in the store, oldest first."""
    return names(spark, f"{store}/{VERSIONS}")


def forget(spark: SparkSession, store: str, current: str, kept: int = KEPT) -> None:
    """Remove versions older than the last `kept` up to the current one; newer ones are other runs' and stay."""
    older = [v for v in versions(spark, store) if v <= current]
    for version in older[:-kept]:
        remove(spark, version_folder(store, version))


@contextmanager
def prepared(spark: SparkSession, store: str) -> Iterator[str]:
    """A new version to write tables into, by `version_folder`; what there is of it goes if the block fails."""
    version = new_version()
    try:
        yield version
    except BaseException:
        remove(spark, version_folder(store, version))
        raise


def turn_folder(spark: SparkSession, store: str, version: str) -> None:
    """From now on readers of the folder store see this version."""
    _point(spark, store, version)


def read_current(spark: SparkSession, store: str, namespace: str, table: str) -> DataFrame:
    """A table of the current version of a folder store."""
    version = current_version(spark, store)
    if version is None:
        raise LookupError(f"nothing has been published to {store}")
    return spark.read.parquet(f"{version_folder(store, version)}/{namespace}/{table.upper()}")


def turn_catalog(spark: SparkSession, locations: Mapping[str, str]) -> None:
    """Set catalog tables (name to folder) to what has been written for them; new ones are created.

    The catalog has no transaction over tables, but every statement only changes
    a location, and comes after all data: each table is whole at any time.
    """
    for name, folder in locations.items():
        path = folder.replace("'", "\\'")
        if spark.catalog.tableExists(name):
            written = spark.read.parquet(folder).schema
            if [(f.name.lower(), f.dataType) for f in spark.table(name).schema] == [(f.name.lower(), f.dataType) for f in written]:
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
                spark.catalog.refreshTable(name)
                continue
            spark.sql(f"DROP TABLE {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
