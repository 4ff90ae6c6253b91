"""Serving tables: conform to the declared layout, replace, report; views on top."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millwright.operators.checks import NullShare, Rule, UniqueKeys
from millwright.operators.ranges import RANGE
from millwright.plans.versions import names
from millwright.schemas import SERVING
from millwright.sources import CODEC

# The two namespaces.
STAGING, ANALYTICS = "staging", "analytics"


# Files of a table that is stored in an order, at most. Each may have any size.
ORDERED_FILES = 64
_ORDER = "order"
_ORDER_SCHEMA = "place int, file string"


@dataclass(frozen=True)
class Published:
    table: str
    location: str
    rows: int
    # Of a table stored in an order: where the list of its files is, and the files in that order.
    order: str | None = None
    files: tuple[str, ...] = ()


def conform(df: DataFrame, table: str, loaded_at: datetime | None = None) -> DataFrame:
    """Columns and types of a serving table.

    Defaults replace NULLs, the load time is stamped where the table has one, an
    absent optional column becomes NULL, and an absent required one is an error.
    """
    spec = SERVING[table]
    present = {name.lower(): name for name in df.columns}
    chosen: list[Column] = []
    for column in spec.columns.fields:
        name, kind = column.name, column.dataType
        if name in spec.stamped:
            value = F.current_timestamp() if loaded_at is None else F.lit(loaded_at)
        elif name in present:
            value = F.col(f"`{present[name]}`")
        elif name in spec.not_null:
            raise ValueError(f"{table} needs the column {name}")
        else:
            value = F.lit(None)
        value = value.cast(kind)
        if name in spec.defaults:
            value = F.coalesce(value, F.lit(spec.defaults[name]).cast(kind))
        chosen.append(value.alias(name))
    return df.select(*chosen)


def constraint_rules(table: str) -> list[Rule]:
    """The declared primary key and NOT NULL columns as data-quality rules."""
    spec = SERVING[table]
    rules: list[Rule] = []
    if spec.primary_key:
        rules.append(UniqueKeys(table, spec.primary_key))
    if spec.not_null:
        rules.append(NullShare(table, spec.not_null, 0.0))
    return rules


def create_namespaces(spark: SparkSession, prefix: str = "") -> None:
    for name in (STAGING, ANALYTICS):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{name}")


def namespace_folder(spark: SparkSession, namespace: str) -> str:
    """Where the catalog keeps a namespace; dropping the namespace removes it."""
    described = {row[0]: row[1] for row in spark.sql(f"DESCRIBE SCHEMA {namespace}").collect()}
    return described["Location"]


def _text(value: str) -> str:
    return "'" + value.replace("'", "\\'") + "'"


def table_definition(table: str, source: str = "parquet", prefix: str = "") -> str:
    """CREATE TABLE for a serving table: types, defaults and comment.

    Keys and NOT NULL are left to `constraint_rules`, since file tables do not
    enforce them.
    """
    spec = SERVING[table]
    columns = []
    for column in spec.columns.fields:
        default = spec.defaults.get(column.name)
        suffix = f" DEFAULT {_text(default)}" if default is not None else ""
        columns.append(f"{column.name} {column.dataType.simpleString()}{suffix}")
    comment = f" COMMENT {_text(spec.comment)}" if spec.comment else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {prefix}{STAGING}.{table.upper()} ({', '.join(columns)}) "
        f"USING {source}{comment}"
    )


def create_tables(spark: SparkSession, source: str = "parquet", prefix: str = "") -> None:
    """Both namespaces and every serving table that does not exist yet."""
    create_namespaces(spark, prefix)
    for table in SERVING:
        spark.sql(table_definition(table, source, prefix))


def n_files(spark: SparkSession) -> int:
    """How many files a table stored in an order has, at most."""
    return min(ORDERED_FILES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def publish(
    df: DataFrame,
    table: str,
    *,
    folder: str | None = None,
    namespace: str = STAGING,
    prefix: str = "",
    source: str = "parquet",
    options: Mapping[str, str] | None = None,
    order: Sequence[Column] = (),
) -> Published:
    """Replace a table with `df`, written by the executors, and report the rows.

    With `folder` the table is `<folder>/<namespace>/<TABLE>`; otherwise it is
    `<prefix><namespace>.<TABLE>` of the catalog, where a defined serving table keeps
    its definition and any other is created or replaced. `source` and `options`
    select any Spark data source that is installed. Failures are raised.

    With `order` (in a folder) the rows are range-partitioned and sorted, so the
    files follow each other in that order, and a list of them is stored beside the
    table: `in_order` reads them one after the other, without a sort. Rows that lie in
    ranges of the order's first column already (`operators.ranges`) are only sorted.
    """
    name = table.upper()
    loaded = Observation()
    if order:
        if folder is None or source != "parquet":
            raise ValueError("only Parquet files of a folder are stored in an order")
        if RANGE in df.columns:
            df = df.sortWithinPartitions(*order).drop(RANGE)
        else:
            # The bounds are sampled, so the last stage of `df` runs twice; its shuffles do not.
            df = df.repartitionByRange(n_files(df.sparkSession), *order).sortWithinPartitions(*order)
    counted = df.observe(loaded, F.count(F.lit(1)).alias("rows"))
    packed = {"compression": CODEC} if source == "parquet" else {}
    writer = counted.write.mode("overwrite").format(source).options(**packed | dict(options or {}))
    if folder is not None:
        location = f"{folder.rstrip('/')}/{namespace}/{name}"
        writer.save(location)
        if order:
            return _listed(df.sparkSession, Published(name, location, loaded.get["rows"], f"{folder.rstrip('/')}/{_ORDER}/{name}"))
    else:
        location = f"{prefix}{namespace}.{name}"
        if namespace == STAGING and table in SERVING and df.sparkSession.catalog.tableExists(location):
            counted.write.insertInto(location, overwrite=True)
        else:
            writer.saveAsTable(location)
    return Published(name, location, loaded.get["rows"])


def _listed(spark: SparkSession, published: Published) -> Published:
    """Store the list of files. The number of a range is in the name of its file, so names are in the order of ranges."""
    files = [f for f in names(spark, published.location) if f.startswith("part-")]  # ORDERED_FILES at most
    listed = F.posexplode(F.array(*[F.lit(f) for f in files]).cast("array<string>")).alias("place", "file")
    spark.range(1, numPartitions=1).select(listed).write.mode("overwrite").parquet(published.order)
    return replace(published, files=tuple(files))


def ordered_files(spark: SparkSession, order: str) -> list[str]:
    """The files of a table stored in an order, from its list; `ORDERED_FILES` at most."""
    return [r.file for r in sorted(spark.read.schema(_ORDER_SCHEMA).parquet(order).collect())]


def in_order(spark: SparkSession, published: Published) -> DataFrame:
    """The rows in the order they were stored in: the files one after the other, nothing is sorted."""
    files = published.files or ordered_files(spark, published.order)
    schema = spark.read.parquet(published.location).schema
    reader = spark.read.schema(schema)
    parts = [reader.parquet(f"{published.location}/{f}") for f in files]
    return reduce(DataFrame.unionAll, parts) if parts else reader.parquet(published.location)


def in_order_sql(published: Published) -> str:
    """The same as SQL, for a view that lasts."""
    files = [f"{published.location}/{f}".replace("`", "``") for f in published.files]
    return " UNION ALL ".join(f"SELECT * FROM parquet.`{f}`" for f in files)


def read_published(spark: SparkSession, published: Published, source: str = "parquet") -> DataFrame:
    if "/" in published.location:
        return spark.read.format(source).load(published.location)
    return spark.table(published.location)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """A lasting view, for every session of the catalog."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
