"""The SQL each registered query is compared with, over the same tables."""

from __future__ import annotations

import standins

_LOGS = standins.sql("machine_logs")
_PRODUCTION = standins.sql("production_records")
_INSPECTIONS = (
    f"SELECT *, TIMESTAMP '2000-01-01 00:00:00' AS ingestion_timestamp "
    f"FROM ({standins.sql('inspection_results')}) i"
)
_MATERIALS = standins.sql("material_batches")
_PRODUCTS = standins.sql("dim_product")
_MACHINES = standins.sql("dim_machine")
_SHIFTS = standins.sql("dim_shift")

_TABLES = f"""
logs AS ({_LOGS}),
production AS ({_PRODUCTION}),
inspections AS ({_INSPECTIONS}),
materials AS ({_MATERIALS}),
products AS ({_PRODUCTS}),
machines AS ({_MACHINES}),
shifts AS ({_SHIFTS})
"""

# Metrics straight from the definition: row-level joins, then one grouping.
_QUALITY = """
quality AS (
    SELECT p.production_line, p.shift_id, p.batch_id, p.production_date,
           CAST(SUM(i.defect_found) AS BIGINT) AS defect_count,
           COUNT(i.inspection_id) AS total_inspected,
           COALESCE(ROUND(CAST(SUM(i.defect_found) AS DOUBLE)
                          / NULLIF(COUNT(i.inspection_id), 0) * 100, 2), 0.0e0) AS defect_rate
    FROM inspections i JOIN production p ON i.batch_id = p.batch_id
    WHERE {kept}
    GROUP BY p.production_line, p.shift_id, p.batch_id, p.production_date
)
"""
_ON_TIME = "epoch_us(i.inspection_timestamp) - epoch_us({reference}) <= 86400000000"
_QUALITY_DEFAULT = _QUALITY.format(kept=_ON_TIME.format(reference="i.ingestion_timestamp"))
_QUALITY_END_TIME = _QUALITY.format(kept=_ON_TIME.format(reference="p.end_time"))

_MINUTES = """
    CAST(SUM(CASE WHEN event_type = 'planned_maintenance' THEN duration_minutes ELSE 0 END) AS BIGINT) AS planned_maint_mins,
    CAST(SUM(CASE WHEN event_type = 'unplanned_breakdown' THEN duration_minutes ELSE 0 END) AS BIGINT) AS unplanned_breakdown_mins,
    CAST(SUM(CASE WHEN event_type = 'changeover' THEN duration_minutes ELSE 0 END) AS BIGINT) AS changeover_mins,
    CAST(SUM(CASE WHEN event_type = 'idle' THEN duration_minutes ELSE 0 END) AS BIGINT) AS idle_mins,
    CAST(SUM(duration_minutes) AS BIGINT) AS total_downtime_mins
"""
_IS_DOWNTIME = "event_type IN ('planned_maintenance', 'unplanned_breakdown', 'changeover', 'idle')"
_AVAILABILITY = "ROUND((480.0e0 - total_downtime_mins) / 480.0e0 * 100, 2) AS machine_availability_pct"


def _downtime(extra_key: str = "") -> str:
    return f"""
downtime AS (
    SELECT *, {_AVAILABILITY} FROM (
        SELECT machine_id, production_line, shift_id, {extra_key} {_MINUTES}
        FROM (SELECT *, CAST(event_ts AS DATE) AS record_date FROM logs) d
        WHERE {_IS_DOWNTIME}
        GROUP BY ALL
    ) g
)
"""


_DAILY = """
daily AS (
    SELECT production_line, shift_id, product_category,
           CAST(DATE_TRUNC('week', production_date) AS DATE) AS prod_week, production_date,
           total_defects, total_units,
           CASE WHEN total_units = 0 THEN 0.0e0
                ELSE CAST(total_defects AS DOUBLE) / NULLIF(total_units, 0) * 100 END AS rate
    FROM (
        SELECT q.production_line, q.shift_id, d.product_category, q.production_date,
               CAST(SUM(q.defect_count) AS BIGINT) AS total_defects,
               CAST(SUM(q.total_inspected) AS BIGINT) AS total_units
        FROM quality q
        LEFT JOIN production p ON q.batch_id = p.batch_id
        LEFT JOIN products d ON p.product_id = d.product_id
        GROUP BY q.production_line, q.shift_id, d.product_category, q.production_date
    ) s
)
"""
_DAILY_COLUMNS = """production_line, shift_id, product_category, prod_week, production_date,
       total_defects, total_units, ROUND(rate, 6) AS daily_defect_rate"""

_HOURLY = """
hourly AS (
    SELECT *, CASE WHEN prod_hours > 0 THEN total_units / prod_hours ELSE 0.0e0 END AS uph
    FROM (
        SELECT production_line, shift_id, production_date,
               CAST(SUM(units_produced) AS BIGINT) AS total_units,
               SUM(date_diff('minute', start_time, end_time)) / 60.0e0 AS prod_hours
        FROM production GROUP BY production_line, shift_id, production_date
    ) s
)
"""

_PREVIOUS = """
previous AS (
    SELECT *, LAG(uph) OVER (PARTITION BY production_line
                             ORDER BY production_date NULLS LAST, shift_id NULLS LAST) AS prev
    FROM hourly
)
"""

_BATCHES = """
batches AS (
    SELECT m.batch_id, m.material_id, m.supplier_id, m.received_date, q.defect_rate
    FROM materials m JOIN quality q ON m.batch_id = q.batch_id
)
"""

_DOWNTIME_COLUMNS = """machine_id, production_line, shift_id, record_date, planned_maint_mins,
       unplanned_breakdown_mins, changeover_mins, idle_mins, total_downtime_mins,
       machine_availability_pct"""
_CUMULATIVE = """CAST(SUM(total_downtime_mins) OVER (
           PARTITION BY machine_id
           ORDER BY record_date NULLS LAST, production_line NULLS LAST, shift_id NULLS LAST
           ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative_30d_downtime_mins"""

_DEVIATION = """
per_day AS (
    SELECT production_date, COUNT(*) AS n_rows FROM production GROUP BY production_date
),
with_history AS (
    SELECT *, AVG(n_rows) OVER (ORDER BY production_date NULLS FIRST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mean
    FROM per_day
),
deviations AS (
    SELECT production_date, n_rows, mean, ABS((n_rows - mean) / NULLIF(mean, 0)) AS gap
    FROM with_history
)
"""

# The landed tables: full-row copies removed.
_LANDED = f"""
logs AS (SELECT DISTINCT * FROM ({_LOGS}) r),
production AS (SELECT DISTINCT * FROM ({_PRODUCTION}) r),
inspections AS (SELECT DISTINCT * FROM ({_INSPECTIONS}) r),
materials AS (SELECT DISTINCT * FROM ({_MATERIALS}) r),
products AS ({_PRODUCTS}),
machines AS ({_MACHINES}),
shifts AS ({_SHIFTS})
"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join((_TABLES, *parts))


def _null_row(table: str, column: str, alias: str) -> str:
    share = f"COUNT(*) FILTER (WHERE {column} IS NULL) / CAST(NULLIF(COUNT(*), 0) AS DOUBLE)"
    return f"""
SELECT 'nulls' AS "check", '{alias}' AS "table", '{column}' AS target,
       ROUND({share}, 6) AS observed, CAST({{threshold}} AS DOUBLE) AS threshold,
       NOT COALESCE({share} > {{threshold}}, FALSE) AS passed
FROM {table}"""


def _duplicate_row(table: str, key: str, alias: str) -> str:
    return f"""
SELECT 'duplicates' AS "check", '{alias}' AS "table", '{key}' AS target,
       CAST(COALESCE(SUM(n), 0) AS DOUBLE) AS observed, 0.0e0 AS threshold,
       COALESCE(SUM(n), 0) <= 0 AS passed
FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {key} HAVING COUNT(*) > 1) g"""


def _counts(dataset: str, table: str) -> str:
    return f"""
SELECT '{dataset}' AS dataset, n AS rows_read, n - k AS rows_dropped, k AS rows_in_bronze
FROM (SELECT COUNT(*) AS n FROM {table}) a, (SELECT COUNT(*) AS k FROM (SELECT DISTINCT * FROM {table}) t) b"""


_UNION = "\nUNION ALL\n"

ORACLES: dict[str, str] = {
    "csv_roundtrip": _with() + """
SELECT DISTINCT CAST(batch_id AS VARCHAR) AS batch_id, CAST(product_id AS VARCHAR) AS product_id,
       production_line, shift_id, units_produced, production_date, start_time, end_time,
       TIMESTAMP '2000-01-01 00:00:00' AS ingestion_timestamp
FROM production""",
    "bronze_table_counts": _with() + _UNION.join([
        _counts(dataset, f"({standins.sql_with_copies(dataset)}) s") for dataset in standins.COPIED
    ]),
    "bronze_ingest": f"""
SELECT DISTINCT *, TIMESTAMP '2000-01-01 00:00:00' AS ingestion_timestamp
FROM ({standins.sql_with_copies("machine_logs")}) r""",
    "bronze_dedup": f"SELECT DISTINCT * FROM ({standins.sql_with_copies('inspection_results')}) r",
    "bronze_dedup_stats": f"""
WITH raw AS ({standins.sql_with_copies("inspection_results")})
SELECT n AS rows_read, k AS rows_kept, n - k AS rows_dropped
FROM (SELECT COUNT(*) AS n FROM raw) a,
     (SELECT COUNT(*) AS k FROM (SELECT DISTINCT * FROM raw) d) b""",
    "inspection_delay_hours": _with() + """
SELECT i.inspection_id, i.batch_id, i.inspection_timestamp, p.end_time,
       (epoch_us(i.inspection_timestamp) - epoch_us(p.end_time)) / 3.6e9 AS delay_hours
FROM inspections i JOIN production p ON i.batch_id = p.batch_id""",
    "silver_late_filter": _with() + f"""
SELECT i.* FROM inspections i WHERE {_ON_TIME.format(reference="i.ingestion_timestamp")}""",
    "silver_late_filter_end_time": _with() + f"""
SELECT i.inspection_id, i.batch_id, i.defect_found, i.inspection_timestamp, p.end_time
FROM inspections i JOIN production p ON i.batch_id = p.batch_id
WHERE {_ON_TIME.format(reference="p.end_time")}""",
    "join_inspection_production": _with() + """
SELECT i.*, p.product_id, p.production_line, p.shift_id, p.units_produced, p.production_date,
       p.start_time, p.end_time
FROM inspections i JOIN production p ON i.batch_id = p.batch_id""",
    "silver_quality": _with(_QUALITY_DEFAULT) + "SELECT * FROM quality",
    "silver_quality_end_time": _with(_QUALITY_END_TIME) + "SELECT * FROM quality",
    "downtime_events": _with() + f"SELECT * FROM logs WHERE {_IS_DOWNTIME}",
    "downtime_by_type": _with() + f"""
SELECT machine_id, shift_id, {_MINUTES} FROM logs WHERE {_IS_DOWNTIME} GROUP BY machine_id, shift_id""",
    "silver_downtime": _with(_downtime()) + "SELECT * FROM downtime",
    "join_quality_product_left": _with(_QUALITY_DEFAULT) + """
SELECT q.*, p.product_id, d.product_category
FROM quality q
LEFT JOIN production p ON q.batch_id = p.batch_id
LEFT JOIN products d ON p.product_id = d.product_id""",
    "prod_week": _with() + """
SELECT batch_id, production_date, CAST(DATE_TRUNC('week', production_date) AS DATE) AS prod_week
FROM production""",
    "defect_rate_daily": _with(_QUALITY_DEFAULT, _DAILY) + f"SELECT {_DAILY_COLUMNS} FROM daily",
    "defect_rate_calendar7": _with(_QUALITY_DEFAULT, _DAILY) + f"""
SELECT {_DAILY_COLUMNS},
       ROUND(AVG(rate) OVER (PARTITION BY production_line, shift_id, product_category
                             ORDER BY production_date
                             RANGE BETWEEN INTERVAL '6' DAY PRECEDING AND CURRENT ROW), 6) AS rolling_7d_defect_rate
FROM daily""",
    "kpi_defect_rate": _with(_QUALITY_DEFAULT, _DAILY) + f"""
SELECT {_DAILY_COLUMNS},
       ROUND(AVG(rate) OVER (PARTITION BY production_line, shift_id, product_category
                             ORDER BY production_date NULLS LAST
                             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_7d_defect_rate
FROM daily
ORDER BY production_date DESC NULLS LAST""",
    "batch_duration_minutes": _with() + """
SELECT batch_id, date_diff('minute', start_time, end_time) AS duration_minutes FROM production""",
    "throughput_uph": _with(_HOURLY) + """
SELECT production_line, shift_id, production_date, total_units,
       ROUND(prod_hours, 6) AS prod_hours, ROUND(uph, 6) AS units_per_hour
FROM hourly""",
    "throughput_rank": _with(_HOURLY) + """
SELECT production_line, shift_id, production_date,
       CAST(RANK() OVER (PARTITION BY production_date ORDER BY uph DESC NULLS LAST) AS INTEGER) AS throughput_rank
FROM hourly""",
    "kpi_throughput": _with(_HOURLY, _PREVIOUS) + """
SELECT production_line, shift_id, production_date,
       ROUND(uph, 6) AS units_per_hour, ROUND(prev, 6) AS prev_shift_uph,
       ROUND((uph - prev) / NULLIF(prev, 0) * 100, 6) AS pct_change_vs_prev,
       CAST(RANK() OVER (PARTITION BY production_date ORDER BY uph DESC NULLS LAST) AS INTEGER) AS throughput_rank
FROM previous""",
    "kpi_downtime": _with(_downtime()) + f"""
SELECT {_DOWNTIME_COLUMNS}, {_CUMULATIVE}
FROM (SELECT *, DATE '2000-01-01' AS record_date FROM downtime) d""",
    "downtime_daily_cumulative": _with(_downtime("record_date,")) + f"""
SELECT {_DOWNTIME_COLUMNS}, {_CUMULATIVE} FROM downtime""",
    "join_material_quality": _with(_QUALITY_DEFAULT, _BATCHES) + "SELECT * FROM batches",
    "high_defect_flag": _with(_QUALITY_DEFAULT) + """
SELECT production_line, shift_id, batch_id, production_date, defect_rate,
       CASE WHEN defect_rate > 5.0e0 THEN TRUE ELSE FALSE END AS is_high_defect_batch
FROM quality""",
    "kpi_material_batch": _with(_QUALITY_DEFAULT, _BATCHES) + """
SELECT *, CASE WHEN defect_rate > 5.0e0 THEN TRUE ELSE FALSE END AS is_high_defect_batch,
       ROUND(AVG(defect_rate) OVER (
           PARTITION BY supplier_id
           ORDER BY received_date NULLS LAST, batch_id NULLS LAST, material_id NULLS LAST, defect_rate NULLS LAST
           ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), 6) AS historical_avg_defect_rate_last_4
FROM batches
ORDER BY supplier_id NULLS LAST, received_date DESC NULLS LAST""",
    "dq_duplicates": _with() + """
SELECT COUNT(*) AS duplicate_keys, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM inspections GROUP BY inspection_id HAVING COUNT(*) > 1) g""",
    "dq_duplicate_rows": _with() + """
SELECT inspection_id, COUNT(*) AS n_rows FROM inspections GROUP BY inspection_id HAVING COUNT(*) > 1""",
    "dq_nulls": _with(_QUALITY_DEFAULT) + """,
joined AS (
    SELECT q.batch_id, p.product_id, d.product_category, q.defect_rate
    FROM quality q
    LEFT JOIN production p ON q.batch_id = p.batch_id
    LEFT JOIN products d ON p.product_id = d.product_id
),
counted AS (
    SELECT 'batch_id' AS column_name, COUNT(*) - COUNT(batch_id) AS n, COUNT(*) AS total FROM joined
    UNION ALL SELECT 'product_id', COUNT(*) - COUNT(product_id), COUNT(*) FROM joined
    UNION ALL SELECT 'product_category', COUNT(*) - COUNT(product_category), COUNT(*) FROM joined
    UNION ALL SELECT 'defect_rate', COUNT(*) - COUNT(defect_rate), COUNT(*) FROM joined
)
SELECT column_name, n AS null_count, ROUND(n / CAST(NULLIF(total, 0) AS DOUBLE), 6) AS null_pct,
       NOT COALESCE(n / CAST(NULLIF(total, 0) AS DOUBLE) > 0.05e0, FALSE) AS passed
FROM counted""",
    "dq_late_events": _with() + """
SELECT n AS late_events, total AS n_rows, n = 0 AS passed FROM (
    SELECT COUNT(*) FILTER (WHERE epoch_us(i.inspection_timestamp) - epoch_us(p.end_time) > 86400000000) AS n,
           COUNT(*) AS total
    FROM inspections i JOIN production p ON i.batch_id = p.batch_id
) c""",
    "dq_row_count_deviation": _with(_DEVIATION) + """
SELECT production_date, n_rows, ROUND(mean, 6) AS historical_avg, ROUND(gap, 6) AS deviation,
       NOT COALESCE(gap > 0.2e0, FALSE) AS passed
FROM deviations""",
    "dq_report": _with(_QUALITY_DEFAULT, _DEVIATION) + _UNION.join([
        _duplicate_row("inspections", "inspection_id", "inspection_results"),
        _duplicate_row("production", "batch_id", "production_records"),
        _null_row("quality", "batch_id", "quality_metrics").format(threshold="0.05e0"),
        _null_row("quality", "defect_rate", "quality_metrics").format(threshold="0.05e0"),
        _null_row("inspections", "inspection_timestamp", "inspection_results").format(threshold="0.05e0"),
        """
SELECT 'late_events', 'inspection_results', 'inspection_timestamp', CAST(n AS DOUBLE), 0.0e0, n = 0
FROM (SELECT COUNT(*) FILTER (
          WHERE epoch_us(inspection_timestamp) - epoch_us(ingestion_timestamp) > 86400000000) AS n
      FROM inspections) c""",
        """
SELECT 'row_count_deviation', 'production_records', 'production_date', ROUND(gap, 6), 0.2e0,
       NOT COALESCE(gap > 0.2e0, FALSE)
FROM deviations WHERE production_date = (SELECT MAX(production_date) FROM deviations)""",
    ]),
    "publish_quality": _with(_QUALITY_DEFAULT) + """
SELECT production_line, shift_id, CAST(batch_id AS VARCHAR) AS batch_id, production_date,
       defect_count, total_inspected, CAST(defect_rate AS DECIMAL(5, 2)) AS defect_rate,
       TIMESTAMP '2000-01-01 00:00:00' AS ingestion_timestamp
FROM quality""",
    "publish_downtime": _with(_downtime()) + """
SELECT * REPLACE (CAST(machine_availability_pct AS DECIMAL(12, 2)) AS machine_availability_pct)
FROM downtime""",
    "publish_inspection": _with() + """
SELECT inspection_id, CAST(batch_id AS VARCHAR) AS batch_id, defect_found = 1 AS defect_found,
       CAST(NULL AS VARCHAR) AS defect_type, CAST(measurement_value AS DECIMAL(10, 4)) AS measurement_value,
       CAST(inspector_id AS VARCHAR) AS inspector_id, inspection_timestamp
FROM inspections""",
    "schema_conformance": _with() + _UNION.join([
        _duplicate_row("machines", "machine_id", "dim_machine"),
        _duplicate_row("products", "product_id", "dim_product"),
        _duplicate_row("production", "batch_id", "fact_production"),
        _duplicate_row("inspections", "inspection_id", "fact_inspection"),
        _null_row("machines", "machine_id", "dim_machine").format(threshold="0.0e0"),
        _null_row("machines", "production_line", "dim_machine").format(threshold="0.0e0"),
        _null_row("products", "product_id", "dim_product").format(threshold="0.0e0"),
        _null_row("production", "batch_id", "fact_production").format(threshold="0.0e0"),
        _null_row("production", "units_produced", "fact_production").format(threshold="0.0e0"),
        _null_row("inspections", "inspection_id", "fact_inspection").format(threshold="0.0e0"),
    ]),
    "dim_machine_defaults": _with() + """
SELECT CAST(machine_id AS VARCHAR) AS machine_id, production_line, model,
       CAST(NULL AS DATE) AS installation_date, COALESCE(status, 'ACTIVE') AS status
FROM machines""",
    "end_to_end": "WITH " + ",".join((_LANDED, _QUALITY_DEFAULT, _DAILY)) + f"""
SELECT {_DAILY_COLUMNS},
       ROUND(AVG(rate) OVER (PARTITION BY production_line, shift_id, product_category
                             ORDER BY production_date NULLS LAST
                             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS rolling_7d_defect_rate
FROM daily""",
    "end_to_end_tables": "WITH " + ",".join(
        (_LANDED, _QUALITY_DEFAULT, _downtime(), _DAILY, _HOURLY, _BATCHES)
    ) + _UNION.join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows FROM {table}"
        for name, table in {
            "fact_quality_metrics": "quality", "fact_downtime_metrics": "downtime",
            "fact_production": "production", "material_batches": "materials",
            "dim_product": "products", "kpi_defect_rate": "daily", "kpi_throughput": "hourly",
            "kpi_downtime": "downtime", "kpi_material_batch_trends": "batches",
        }.items()
    ),
}

_GRAINS = {
    "quality": ("quality_metrics", "production_line,shift_id,batch_id,production_date"),
    "downtime": ("downtime_metrics", "machine_id,production_line,shift_id"),
}
_REQUIRED = {
    "production": ("FACT_PRODUCTION", "batch_id", ("batch_id", "units_produced")),
    "products": ("DIM_PRODUCT", "product_id", ("product_id",)),
    "machines": ("DIM_MACHINE", "machine_id", ("machine_id", "production_line")),
    "shifts": ("DIM_SHIFT", "shift_id", ("shift_id",)),
}
_GATE = _UNION.join([
    *(_duplicate_row(table, keys, alias) for table, (alias, keys) in _GRAINS.items()),
    *(
        _null_row(table, column, alias).format(threshold="0.05e0")
        for table, (alias, keys) in _GRAINS.items() for column in keys.split(",")
    ),
    _duplicate_row("inspections", "inspection_id", "inspection_results"),
    """
SELECT 'late_events', 'inspection_results', 'inspection_timestamp', CAST(n AS DOUBLE), 0.0e0, n = 0
FROM (SELECT COUNT(*) FILTER (
          WHERE epoch_us(inspection_timestamp) - epoch_us(ingestion_timestamp) > 86400000000) AS n
      FROM inspections) c""",
    *(_duplicate_row(table, key, alias) for table, (alias, key, _) in _REQUIRED.items()),
    *(
        _null_row(table, column, alias).format(threshold="0.0e0")
        for table, (alias, _, columns) in _REQUIRED.items() for column in columns
    ),
])

# The same results by another plan, and what depends on the order of rows or on the catalog.
ORACLES |= {
    "silver_quality_end_time_split": ORACLES["silver_quality_end_time"],
    "kpi_throughput_split": ORACLES["kpi_throughput"],
    "throughput_rank_split": _with(_HOURLY) + """
SELECT production_line, shift_id, production_date,
       CAST(RANK() OVER (PARTITION BY production_line ORDER BY uph DESC NULLS LAST) AS INTEGER) AS line_rank
FROM hourly""",
    "downtime_daily_cumulative_split": ORACLES["downtime_daily_cumulative"],
    "kpi_material_batch_split": ORACLES["kpi_material_batch"],
    "gate_report": _with(_QUALITY_DEFAULT, _downtime()) + _GATE,
    "display_order_defect_rate": _with(_QUALITY_DEFAULT, _DAILY) + """
SELECT production_date, production_line, shift_id, product_category,
       ROW_NUMBER() OVER (ORDER BY production_date DESC NULLS LAST, production_line NULLS LAST,
                                   shift_id NULLS LAST, product_category NULLS LAST) AS place
FROM daily""",
    "display_order_material_batch": _with(_QUALITY_DEFAULT, _BATCHES) + """
SELECT supplier_id, received_date, batch_id, material_id, defect_rate,
       ROW_NUMBER() OVER (ORDER BY supplier_id NULLS LAST, received_date DESC NULLS LAST, batch_id NULLS LAST,
                                   material_id NULLS LAST, defect_rate NULLS LAST) AS place
FROM batches""",
    "catalog_tables": "WITH " + ",".join((_LANDED, _QUALITY_DEFAULT, _downtime())) + _UNION.join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows, {columns} AS n_columns FROM {table}"
        for name, (table, columns) in {
            "dim_machine": ("machines", 5), "dim_product": ("products", 3), "dim_shift": ("shifts", 4),
            "fact_production": ("production", 8), "fact_inspection": ("inspections", 7),
            "fact_quality_metrics": ("quality", 8), "fact_downtime_metrics": ("downtime", 9),
            "material_batches": ("materials", 5),
        }.items()
    ),
    "catalog_kpi_throughput": "WITH " + ",".join((_LANDED, _HOURLY, _PREVIOUS)) + """
SELECT production_line, shift_id, production_date,
       ROUND(uph, 6) AS units_per_hour, ROUND(prev, 6) AS prev_shift_uph,
       ROUND((uph - prev) / NULLIF(prev, 0) * 100, 6) AS pct_change_vs_prev,
       CAST(RANK() OVER (PARTITION BY production_date ORDER BY uph DESC NULLS LAST) AS INTEGER) AS throughput_rank
FROM previous""",
}

# Deliveries, versions, the gate's states, and a hot right side.
_PRODUCTION_COPIES = f"copied AS ({standins.sql_with_copies('production_records')})"
_DELIVERED = {
    "machine_logs": "logs", "production_records": "production", "inspection_results": "raw_inspections",
    "material_batches": "materials",
}


def _delivery(table: str, alias: str, number: int) -> str:
    """Rows of a delivery, and its distinct rows that no delivery before it held."""
    part = f"SELECT * FROM {alias} WHERE {standins.delivered(table, number)}"
    before = "".join(f" EXCEPT SELECT * FROM {alias} WHERE {standins.delivered(table, n)}" for n in range(number))
    return f"""
SELECT '{table} {number + 1}' AS delivery, (SELECT COUNT(*) FROM ({part}) r) AS rows_read,
       (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ({part}) d {before}) f) AS rows_new"""


ORACLES |= {
    "join_quality_product_left_split": _with(_QUALITY_DEFAULT, _PRODUCTION_COPIES) + """
SELECT q.*, p.product_id, d.product_category
FROM quality q LEFT JOIN copied p ON q.batch_id = p.batch_id LEFT JOIN products d ON p.product_id = d.product_id""",
    "dq_late_share": _with() + """,
late AS (
    SELECT COUNT(*) FILTER (WHERE epoch_us(inspection_timestamp) - epoch_us(ingestion_timestamp) > 86400000000)
           / CAST(COUNT(*) AS DOUBLE) AS share
    FROM inspections
)
SELECT 'late_share' AS "check", 'inspection_results' AS "table", 'inspection_timestamp' AS target,
       ROUND(share, 6) AS observed, threshold, share <= threshold AS passed, "limit"
FROM late, (VALUES ('strict', 0.1e0), ('loose', 0.5e0)) t("limit", threshold)""",
    "gate_states": _with() + """,
repeated AS (
    SELECT CAST(SUM(n) AS BIGINT) AS n FROM (SELECT COUNT(*) AS n FROM inspections GROUP BY inspection_id HAVING COUNT(*) > 1) r
)
SELECT state, may_publish, CASE WHEN state = 'failed after a pass' THEN (SELECT n FROM repeated) END AS repeated_rows
FROM (VALUES ('ingested, no metrics', false), ('not checked', false), ('passed', true), ('failed after a pass', false),
             ('passed again', true), ('new ingest, old metrics', false)) s(state, may_publish)""",
    "publish_version": _with() + _UNION.join(
        f"SELECT '{name}' AS table_name, CAST({key} AS VARCHAR) AS key FROM {table}"
        for name, (table, key) in {
            "dim_product": ("products", "product_id"), "dim_shift": ("shifts", "shift_id"),
            "fact_production": ("production", "batch_id"),
        }.items()
    ),
    "daily_deliveries": _with() + f", raw_inspections AS ({standins.sql('inspection_results')})" + _UNION.join(
        _delivery(table, alias, number)
        for table, alias in _DELIVERED.items() for number in range(len(standins.DELIVERIES))
    ),
}

# Landed in three deliveries, metrics and indicators are those of the distinct rows at once.
_ONCE = f"""
logs AS (SELECT DISTINCT * FROM ({_LOGS}) r),
production AS (SELECT DISTINCT * FROM ({_PRODUCTION}) r),
inspections AS (SELECT DISTINCT * FROM ({_INSPECTIONS}) r),
materials AS (SELECT DISTINCT * FROM ({_MATERIALS}) r),
products AS ({_PRODUCTS})
"""


def _once(name: str) -> str:
    """The SQL of a registered query over the distinct raw rows."""
    assert _TABLES in ORACLES[name]
    return ORACLES[name].replace(_TABLES, _ONCE)


ORACLES |= {
    "daily_quality": _once("silver_quality"),
    "daily_downtime": _once("silver_downtime"),
    "daily_kpi_downtime": _once("downtime_daily_cumulative"),
    "daily_kpi_defect_rate": _once("kpi_defect_rate"),
    "daily_kpi_throughput": _once("kpi_throughput"),
    "daily_kpi_material_batch": _once("kpi_material_batch"),
}

_LANDED_GATE = _UNION.join([
    *(_duplicate_row(table, keys, alias) for table, (alias, keys) in _GRAINS.items()),
    *(
        _null_row(table, column, alias).format(threshold="0.05e0")
        for table, (alias, keys) in _GRAINS.items() for column in keys.split(",")
    ),
    _duplicate_row("inspections", "inspection_id", "inspection_results"),
    """
SELECT 'late_events', 'inspection_results', 'inspection_timestamp', CAST(n AS DOUBLE), 0.0e0, n = 0
FROM (SELECT COUNT(*) FILTER (
          WHERE epoch_us(inspection_timestamp) - epoch_us(ingestion_timestamp) > 86400000000) AS n
      FROM inspections) c""",
    _duplicate_row("production", "batch_id", "FACT_PRODUCTION"),
    *(_null_row("production", column, "FACT_PRODUCTION").format(threshold="0.0e0") for column in ("batch_id", "units_produced")),
])

ORACLES |= {
    "gate_observed": "WITH " + ",".join((_LANDED, _QUALITY_DEFAULT, _downtime())) + _LANDED_GATE,
    "csv_quarantine": _with() + """,
distinct_rows AS (SELECT DISTINCT * FROM production),
told AS (
    SELECT CASE WHEN batch_id % 10 = 3 AND batch_id % 25 = 7 THEN 'does not fit: units_produced, start_time'
                WHEN batch_id % 10 = 3 THEN 'does not fit: units_produced'
                WHEN batch_id % 25 = 7 THEN 'does not fit: start_time' ELSE 'kept' END AS reason
    FROM distinct_rows
)
SELECT reason, COUNT(*) AS n_rows FROM told GROUP BY reason
UNION ALL SELECT 'read', COUNT(*) FROM production
UNION ALL SELECT 'copies', (SELECT COUNT(*) FROM production WHERE NOT (batch_id % 10 = 3 OR batch_id % 25 = 7))
                           - (SELECT COUNT(*) FROM told WHERE reason = 'kept')
UNION ALL SELECT 'rejected', COUNT(*) FROM production WHERE batch_id % 10 = 3 OR batch_id % 25 = 7""",
}

ORACLES["stream_downtime"] = f"""
SELECT machine_id, production_line, shift_id, CAST(event_ts AS DATE) AS record_date, {_MINUTES}
FROM (SELECT DISTINCT * FROM ({_LOGS}) d) l WHERE {_IS_DOWNTIME}
GROUP BY machine_id, production_line, shift_id, CAST(event_ts AS DATE)"""
