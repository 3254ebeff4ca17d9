"""Employee feed to a type-2 dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import payload as P
from ..functions.temporal import epoch_millis, epoch_or_text, parse_date
from ..functions.text import full_name, record_hash
from ..operators.cleaning import add_constants, blank_strings_to_null, require
from ..operators.latest import keep_latest
from ..sources.files import FAILED_MARK
from ..sources.lake import CLOSED_BATCH, Lake
from .incremental import load_new_dimension
from .intake import archive, take_in

# Source fields and their warehouse names.
FIELDS = {
    "EmployeeID": "employee_id",
    "Zoho_ID": "zoho_id",
    "ZUID": "zuid",
    "FirstName": "first_name",
    "LastName": "last_name",
    "EmailID": "email_id",
    "Other_Email": "other_email",
    "Mobile": "mobile",
    "Work_phone": "work_phone",
    "Date_of_birth": "date_of_birth",
    "Department": "department",
    "Designation": "designation",
    "Reporting_To": "reporting_to",
    "Role": "role",
    "Employee_type": "employee_type",
    "Employeestatus": "employee_status",
    "Dateofjoining": "date_of_joining",
    "Dateofexit": "date_of_exit",
    "LocationName": "location_name",
    "Work_location": "work_location",
    "AddedBy": "added_by",
    "AddedTime": "added_time",
    "ModifiedBy": "modified_by",
    "ModifiedTime": "modified_time",
    "ApprovalStatus": "approval_status",
    "Source_of_hire": "source_of_hire",
}
DATE_COLUMNS = ("date_of_birth", "date_of_joining", "date_of_exit")
NOT_HASHED = ("employee_id", "dw_load_timestamp", "record_hash", "ingest_timestamp")


def decode(bronze: DataFrame) -> DataFrame:
    """One row per employee record, whatever shape the payload has."""
    payload = P.locate(F.col("raw_json"), P.EMPLOYEE_PATHS, or_whole_line=True)
    records = P.explode_records(bronze, P.record_texts(payload, "EmployeeID"), P.struct_ddl(FIELDS), "ingest_timestamp")
    return records.select("ingest_timestamp", *P.renamed("record", FIELDS))


def clean(decoded: DataFrame, parity_hash: bool = False, keep_ingest: bool = False) -> DataFrame:
    """Typed columns, derived columns and the record hash; one row per employee.  ``keep_ingest`` leaves the ingest time in."""
    flat = blank_strings_to_null(decoded, list(FIELDS.values()))
    flat = flat.withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))
    flat = add_constants(flat, {"is_billable": 0}, {"source_row_id": "int"})
    flat = flat.withColumns({c: parse_date(F.col(c)) for c in DATE_COLUMNS})
    flat = flat.withColumns({"modified_time": epoch_millis(F.col("modified_time")),
                             "added_time": epoch_or_text(F.col("added_time"))})
    hashed = [c for c in flat.columns if c not in NOT_HASHED]
    flat = flat.withColumn("record_hash", record_hash(hashed, parity=parity_hash))
    latest = keep_latest(require(flat, "employee_id"), ["employee_id"], ["ingest_timestamp"])
    return latest if keep_ingest else latest.drop("ingest_timestamp")


def silver(bronze: DataFrame, parity_hash: bool = False, keep_ingest: bool = False) -> DataFrame:
    return clean(decode(bronze), parity_hash, keep_ingest)


def load(lake: Lake, catalog: str = "hr", as_of: Column | None = None) -> bool:
    """New bronze batches to silver and into the dimension; False without any."""
    return load_new_dimension(lake, f"{catalog}.bronze.employee_raw", f"{catalog}.silver.employee_cleaned", f"{catalog}.gold.dim_employee",
                              "employee_id", lambda df: silver(df, keep_ingest=True), "dim_employee_key", as_of)


def run(lake: Lake, folder: str, catalog: str = "hr", as_of: Column | None = None,
        archive_to: str | None = None, serving=None, once: bool = False) -> bool:
    """Files to bronze, bronze to silver, silver into the dimension, its current versions to serving.  False without files."""
    paths = take_in(lake, folder, f"{catalog}.bronze.employee_raw", as_of, exclude=FAILED_MARK, once=once)
    if not paths:
        return False
    load(lake, catalog, as_of)
    if serving is not None:
        current = lake.read(f"{catalog}.gold.dim_employee").where("is_current = 1").drop(CLOSED_BATCH)
        serving.sync_dimension(current, "dim_employee", "employee_id", "dim_employee_key")
    archive(lake, paths, folder, archive_to)
    return True
