"""Column lists of the stored tables, as Spark DDL strings.

Fixed values: names and meanings follow the snapshot / event / metric tables the
library maintains; everything else derives from these strings.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

KEYS = ["table_name", "primary_key"]
OPERATIONS = ["INSERT", "UPDATE", "DELETE"]
BRONZE_METADATA = ["_ingestion_timestamp", "reference_date", "_source", "_source_table"]

SNAPSHOT_RAW = (
    "ref_date DATE, table_name STRING, primary_key STRING, row_hash STRING, "
    "data STRING, ingestion_timestamp TIMESTAMP"
)
SNAPSHOT_KEYS = "table_name STRING, primary_key STRING, row_hash STRING, copies BIGINT"
INGESTION_CONTROL = (
    "ref_date DATE, table_name STRING, schema_name STRING, row_count BIGINT, "
    "ingestion_start TIMESTAMP, ingestion_end TIMESTAMP, status STRING, error_message STRING"
)
DELTA_EVENTS = (
    "ref_date DATE, table_name STRING, primary_key STRING, operation_type STRING, "
    "row_hash_before STRING, row_hash_after STRING, data_before STRING, data_after STRING, "
    "detected_at TIMESTAMP"
)
CURRENT_STATE = (
    "table_name STRING, primary_key STRING, row_hash STRING, data STRING, "
    "first_seen_date DATE, last_seen_date DATE, is_active INT, updated_at TIMESTAMP"
)
DAILY_CHANGE_METRICS = (
    "ref_date DATE, table_name STRING, total_inserts BIGINT, total_updates BIGINT, "
    "total_deletes BIGINT, total_active_records BIGINT, calculated_at TIMESTAMP"
)
DATA_QUALITY_METRICS = (
    "ref_date DATE, table_name STRING, null_count BIGINT, duplicate_count BIGINT, "
    "total_records BIGINT, quality_score DOUBLE, calculated_at TIMESTAMP"
)
TABLE_METADATA = (
    "domain STRING, layer STRING, name STRING, source_system STRING, owner STRING, "
    "description STRING, pii BOOLEAN, retention_days INT, created_at TIMESTAMP, "
    "updated_at TIMESTAMP, row_count BIGINT, size_mb DOUBLE"
)
LINEAGE = (
    "source_table STRING, target_table STRING, transformation_type STRING, "
    "pipeline_name STRING, execution_timestamp TIMESTAMP"
)
RUN_METRICS = (
    "domain STRING, layer STRING, start_time TIMESTAMP, end_time TIMESTAMP, status STRING, "
    "rows_processed BIGINT, rows_failed BIGINT, "
    "errors ARRAY<STRUCT<timestamp: TIMESTAMP, error: STRING>>, duration_seconds DOUBLE"
)

# layer -> table -> (columns, sort key)
MEDALLION = {
    "bronze": {
        "snapshot_raw": (SNAPSHOT_RAW, ["ref_date", "table_name", "primary_key"]),
        "ingestion_control": (INGESTION_CONTROL, ["ref_date", "table_name"]),
    },
    "silver": {
        "delta_events": (
            DELTA_EVENTS,
            ["ref_date", "table_name", "primary_key", "operation_type"],
        ),
        "current_state": (CURRENT_STATE, ["table_name", "primary_key"]),
    },
    "gold": {
        "daily_change_metrics": (DAILY_CHANGE_METRICS, ["ref_date", "table_name"]),
        "data_quality_metrics": (DATA_QUALITY_METRICS, ["ref_date", "table_name"]),
    },
}

# Columns that the jobs partition a stored table by, where not by its day alone.
STORED_BY = {"snapshot_raw": "ref_date, table_name", "current_state": "version, table_name"}


def struct_of(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def column_names(ddl: str) -> list[str]:
    """Names in a flat column list; needs no session."""
    return [column.split()[0] for column in ddl.split(", ")]
