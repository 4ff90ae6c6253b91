"""Column names and types of every table, with the constraints the serving tables declare."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_STR, _INT, _LONG, _DBL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DATE, _TS, _BOOL = T.DateType(), T.TimestampType(), T.BooleanType()

INGESTED_AT = "ingestion_timestamp"


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Layout of the four raw files.
RAW: dict[str, T.StructType] = {
    "machine_logs": _struct(
        machine_id=_STR, timestamp=_TS, event_type=_STR, duration_minutes=_INT,
        production_line=_STR, shift_id=_STR,
    ),
    "production_records": _struct(
        batch_id=_STR, product_id=_STR, production_line=_STR, shift_id=_STR,
        units_produced=_INT, production_date=_DATE, start_time=_TS, end_time=_TS,
    ),
    "inspection_results": _struct(
        inspection_id=_STR, batch_id=_STR, defect_found=_INT, defect_type=_STR,
        measurement_value=_DBL, inspector_id=_STR, inspection_timestamp=_TS,
    ),
    "material_batches": _struct(
        batch_id=_STR, material_id=_STR, supplier_id=_STR, received_date=_DATE,
        quality_grade=_STR,
    ),
}

BRONZE = {
    name: T.StructType([*schema.fields, T.StructField(INGESTED_AT, _TS)])
    for name, schema in RAW.items()
}

# Layout of the two metric tables.
SILVER: dict[str, T.StructType] = {
    "quality_metrics": _struct(
        production_line=_STR, shift_id=_STR, batch_id=_STR, production_date=_DATE,
        defect_count=_LONG, total_inspected=_LONG, defect_rate=_DBL,
    ),
    "downtime_metrics": _struct(
        machine_id=_STR, production_line=_STR, shift_id=_STR, planned_maint_mins=_LONG,
        unplanned_breakdown_mins=_LONG, changeover_mins=_LONG, idle_mins=_LONG,
        total_downtime_mins=_LONG, machine_availability_pct=_DBL,
    ),
}


@dataclass(frozen=True)
class ServingTable:
    columns: T.StructType
    primary_key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    defaults: dict[str, str] = field(default_factory=dict)
    stamped: tuple[str, ...] = ()
    comment: str | None = None

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(dict.fromkeys(self.primary_key + self.required))


# Layout of the serving tables. Counts and minutes are 64-bit
# because the sums behind them are; availability is wide because it is not
# clamped and falls far below zero; a time of day is text `HH:mm:ss`.
SERVING: dict[str, ServingTable] = {
    "dim_machine": ServingTable(
        _struct(machine_id=_STR, production_line=_STR, model=_STR, installation_date=_DATE,
                status=_STR),
        primary_key=("machine_id",), required=("production_line",),
        defaults={"status": "ACTIVE"},
        comment="Dimension table for manufacturing machines",
    ),
    "dim_product": ServingTable(
        _struct(product_id=_STR, product_category=_STR, unit_price=T.DecimalType(10, 2)),
        primary_key=("product_id",),
    ),
    "dim_shift": ServingTable(
        _struct(shift_id=_STR, shift_name=_STR, start_time=_STR, end_time=_STR),
        primary_key=("shift_id",),
    ),
    "fact_production": ServingTable(
        _struct(batch_id=_STR, product_id=_STR, production_line=_STR, shift_id=_STR,
                units_produced=_INT, production_date=_DATE, start_time=_TS, end_time=_TS),
        primary_key=("batch_id",), required=("units_produced",),
    ),
    "fact_inspection": ServingTable(
        _struct(inspection_id=_STR, batch_id=_STR, defect_found=_BOOL, defect_type=_STR,
                measurement_value=T.DecimalType(10, 4), inspector_id=_STR,
                inspection_timestamp=_TS),
        primary_key=("inspection_id",),
    ),
    "fact_quality_metrics": ServingTable(
        _struct(production_line=_STR, shift_id=_STR, batch_id=_STR, production_date=_DATE,
                defect_count=_LONG, total_inspected=_LONG, defect_rate=T.DecimalType(5, 2),
                ingestion_timestamp=_TS),
        stamped=(INGESTED_AT,),
    ),
    "fact_downtime_metrics": ServingTable(
        _struct(machine_id=_STR, production_line=_STR, shift_id=_STR, planned_maint_mins=_LONG,
                unplanned_breakdown_mins=_LONG, changeover_mins=_LONG, idle_mins=_LONG,
                total_downtime_mins=_LONG, machine_availability_pct=T.DecimalType(12, 2)),
    ),
    "material_batches": ServingTable(RAW["material_batches"]),
}
