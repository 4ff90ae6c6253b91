"""The factory tables as projections of the test tables.

Each expression is valid in Spark SQL and in DuckDB, so the same text serves
the queries and the SQL they are compared with.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class StandIn:
    source: str
    columns: dict[str, str]
    distinct: bool = False

    def sql(self, source: str) -> str:
        chosen = ", ".join(f"{text} AS {name}" for name, text in self.columns.items())
        return f"SELECT {'DISTINCT ' if self.distinct else ''}{chosen} FROM {source}"


# The projections.
STAND_INS: dict[str, StandIn] = {
    "machine_logs": StandIn("events", {
        "machine_id": "concat('MACH_', lpad(cast(user_id % 20 + 1 as varchar(10)), 3, '0'))",
        "event_ts": "ts",
        "event_type": "case event_type when 'view' then 'running' when 'click' then 'changeover' "
                      "when 'error' then 'unplanned_breakdown' "
                      "when 'signup' then 'planned_maintenance' else 'idle' end",
        "duration_minutes": "cast(floor(value) as int)",
        "production_line": "concat('LINE_', cast(user_id % 4 as varchar(10)))",
        "shift_id": "concat('S', cast(cast(floor(extract(hour from ts) / 8) as int) + 1 as varchar(10)))",
    }),
    "production_records": StandIn("orders", {
        "batch_id": "o_orderkey",
        "product_id": "o_custkey * 2",
        "production_line": "concat('LINE_', o_orderstatus)",
        "shift_id": "concat('S', substring(o_orderpriority, 1, 1))",
        "units_produced": "cast(floor(o_totalprice / 100) as int)",
        "production_date": "cast(o_orderdate as date)",
        "start_time": "o_orderdate",
        "end_time": "o_orderdate + interval '1' hour * cast(4 + o_orderkey % 5 as int)",
    }),
    "inspection_results": StandIn("lineitem", {
        "inspection_id": "concat(cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(10)))",
        "batch_id": "l_orderkey",
        "defect_found": "case when l_returnflag = 'R' and l_discount >= 0.07e0 then 1 else 0 end",
        "measurement_value": "l_tax",
        "inspector_id": "l_suppkey",
        "inspection_timestamp": "l_shipdate",
    }),
    "material_batches": StandIn("lineitem", {
        "batch_id": "l_orderkey",
        "material_id": "l_partkey",
        "supplier_id": "l_suppkey",
        "received_date": "cast(l_shipdate as date)",
        "quality_grade": "l_returnflag",
    }),
    "dim_shift": StandIn("orders", {
        "shift_id": "concat('S', substring(o_orderpriority, 1, 1))",
        "shift_name": "substring(o_orderpriority, 3, 20)",
        "start_time": "concat(lpad(cast((cast(substring(o_orderpriority, 1, 1) as int) - 1) * 4 as varchar(10)), 2, '0'), ':00:00')",
        "end_time": "concat(lpad(cast(cast(substring(o_orderpriority, 1, 1) as int) * 4 as varchar(10)), 2, '0'), ':00:00')",
    }, distinct=True),
    "dim_product": StandIn("part", {
        "product_id": "p_partkey",
        "product_category": "p_type",
        "unit_price": "p_retailprice",
    }),
    "dim_machine": StandIn("supplier", {
        "machine_id": "s_suppkey",
        "production_line": "cast(s_nationkey as varchar(10))",
        "model": "s_name",
        "status": "cast(null as varchar(20))",
    }),
}


# Which rows of a raw table come a second time where copies are wanted.
COPIED: dict[str, str] = {
    "machine_logs": "duration_minutes % 3 = 0",
    "production_records": "batch_id % 5 = 0",
    "inspection_results": "batch_id % 4 = 0",
    "material_batches": "batch_id % 7 = 0",
}


# Three deliveries of each raw table. The second holds what comes after the first; the third
# the rest, rows of the second's time that were late, and copies of rows that were landed before.
_FIRST, _SECOND = "{day} < timestamp '{from_}'", "{day} >= timestamp '{from_}' and {day} < timestamp '{to}' and {key} % 10 <> 3"
_THIRD = "{day} is null or {day} >= timestamp '{to}' or {day} >= timestamp '{from_}' and ({key} % 10 = 3 or {key} % 7 = 0)"
_DELIVERED = {
    "machine_logs": {"day": "event_ts", "key": "duration_minutes", "from_": "2024-01-15 00:00:00", "to": "2024-01-25 00:00:00"},
    "production_records": {"day": "start_time", "key": "batch_id", "from_": "1998-01-01 00:00:00", "to": "1999-01-01 00:00:00"},
    "inspection_results": {"day": "inspection_timestamp", "key": "batch_id", "from_": "1998-01-01 00:00:00", "to": "1999-01-01 00:00:00"},
    "material_batches": {"day": "received_date", "key": "batch_id", "from_": "1998-01-01 00:00:00", "to": "1999-01-01 00:00:00"},
}
DELIVERIES = (_FIRST, _SECOND, _THIRD)


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    stand_in = STAND_INS[table]
    df = spark.read.parquet(f"{folder}/{stand_in.source}.parquet")
    df = df.selectExpr(*[f"{text} AS {name}" for name, text in stand_in.columns.items()])
    return df.distinct() if stand_in.distinct else df


def sql(table: str) -> str:
    stand_in = STAND_INS[table]
    return stand_in.sql(stand_in.source)


def with_copies(df: DataFrame, table: str) -> DataFrame:
    """A raw table in which a fixed share of the rows comes twice."""
    return df.unionAll(df.where(COPIED[table]))


def sql_with_copies(table: str) -> str:
    return f"SELECT * FROM ({sql(table)}) a UNION ALL SELECT * FROM ({sql(table)}) b WHERE {COPIED[table]}"


def delivered(table: str, number: int) -> str:
    """The condition that rows of a delivery meet; together the deliveries hold every row."""
    return DELIVERIES[number].format(**_DELIVERED[table])
