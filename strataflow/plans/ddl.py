"""Catalog tables of the gold layer, derived from what the plans write."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from ..operators.scd import VERSION_COLUMNS
from ..sources.lake import SCD_PARTITIONS, create_schemas, create_table
from . import attendance, biometric, employee, leave, timesheet

_KEYS = {"dim_employee_key": "bigint", "dim_date_key": "int", "dw_load_timestamp": "timestamp"}
_TYPES = {
    # Columns that are not text.
    "date_of_birth": "date", "date_of_joining": "date", "date_of_exit": "date", "added_time": "timestamp",
    "modified_time": "timestamp", "is_billable": "int", "source_row_id": "int", "source_attendance_id": "bigint",
    "ercno": "bigint", "first_in_ts": "timestamp", "last_out_ts": "timestamp", "work_minutes": "int",
    "total_minutes": "int", "ot_minutes": "int", "work_date": "date", "source_leave_id": "bigint",
    "date_of_request": "date", "from_date": "date", "to_date": "date", "zuid_in_leave": "bigint",
    "leave_count": "decimal(4,1)", "source_log_id": "int",
}
_KINDS = {"text": "string", "long": "bigint", "int": "int", "flag": "tinyint"}


def _schema(columns, types: dict[str, str]) -> T.StructType:
    ddl = ", ".join(f"`{c}` {types.get(c) or _KEYS.get(c) or _TYPES.get(c, 'string')}" for c in columns)
    return T.StructType.fromDDL(ddl)


def gold_schemas() -> dict[str, T.StructType]:
    sheet_types = {name: _KINDS[kind] for name, kind in timesheet.FIELDS.values()}
    person = list(employee.FIELDS.values()) + ["full_name", "is_billable", "source_row_id", "record_hash", "dim_employee_key"]
    tables = {
        "dim_employee": _schema(person + [c for c in VERSION_COLUMNS if c not in SCD_PARTITIONS] + SCD_PARTITIONS, VERSION_COLUMNS),
        "fact_attendance": _schema(attendance.FACT_COLUMNS + ("dw_load_timestamp", "work_date"), {}),
        "fact_attendance_biometric": _schema(biometric.FACT_COLUMNS + ("remarks", "dw_load_timestamp"), {}),
        "fact_leave": _schema(leave.FACT_COLUMNS + ("dw_load_timestamp",), {}),
        "fact_timesheet": _schema(timesheet.FACT_COLUMNS + ("dw_load_timestamp",), sheet_types),
    }
    return tables


PARTITIONS = {"dim_employee": tuple(SCD_PARTITIONS), "fact_attendance": ("work_date",), "fact_attendance_biometric": ("work_date",)}


def create_gold_tables(spark: SparkSession) -> None:
    """Create the layer schemas and the gold tables that do not exist yet."""
    create_schemas(spark)
    for name, schema in gold_schemas().items():
        create_table(spark, f"gold.{name}", schema, PARTITIONS.get(name, ()))
