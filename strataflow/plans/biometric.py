"""Biometric report extracts to a fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import to_int
from ..functions.temporal import clock_to_minutes, parse_date
from ..functions.text import report_date_text
from ..operators.cleaning import in_batch_dates, require, resolve_alias, sanitise_headers
from ..operators.dims import enrich, resolved
from ..operators.latest import keep_latest
from ..operators.layout import stage
from ..sources.files import list_files, read_sheets
from ..sources.lake import Lake
from .intake import archive

# Source columns and their warehouse names; aliases; the fact's columns.
FIELDS = {
    "Shift": "shift_in_bio",
    "A_InTime": "bio_in_time_str",
    "A_OutTime": "bio_out_time_str",
    "Work_Dur": "bio_work_dur_str",
    "OT": "ot_str",
    "Tot_Dur": "bio_total_dur_str",
    "Status": "bio_status",
}
CODE_NAMES = ("e_code", "ecode")
PERSON_NAMES = ("name", "empname")
FACT_COLUMNS = (
    "dim_employee_key", "dim_date_key", "source_bio_id", "name_in_bio", "shift_in_bio", "bio_in_time_str",
    "bio_out_time_str", "bio_work_dur_str", "ot_str", "bio_total_dur_str", "bio_status", "work_date", "work_minutes",
    "total_minutes", "ot_minutes")


def bronze_rows(report: DataFrame, report_date: Column) -> DataFrame:
    """Report rows with clean headers and the report's date."""
    return sanitise_headers(report).withColumn("ingest_work_date", report_date.cast("date"))


def silver(bronze: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Typed rows, latest per employee and date; limited to the dates of ``batch`` when one is given."""
    rows = bronze if batch is None else in_batch_dates(bronze, batch, "ingest_work_date")
    typed = rows.select(
        to_int(resolve_alias(rows, *CODE_NAMES)).alias("employee_id"), resolve_alias(rows, *PERSON_NAMES).alias("name_in_bio"),
        *[F.col(source).alias(target) for source, target in FIELDS.items()],
        F.col("ingest_work_date").alias("work_date"), "ingest_timestamp")
    timed = require(typed, "employee_id").withColumns({
        "work_minutes": clock_to_minutes(F.col("bio_work_dur_str")),
        "total_minutes": clock_to_minutes(F.col("bio_total_dur_str")),
        "ot_minutes": clock_to_minutes(F.col("ot_str"))})
    return keep_latest(timed, ["employee_id", "work_date"], ["ingest_timestamp"])


def gold(silver_df: DataFrame, dim_employee: DataFrame, dim_date: DataFrame, as_of: Column | None = None) -> DataFrame:
    facts = resolved(enrich(silver_df, dim_employee, dim_date))
    stamp = F.current_timestamp() if as_of is None else as_of
    return facts.withColumn("source_bio_id", F.col("employee_id").cast("string")) \
        .select(*FACT_COLUMNS, stamp.alias("dw_load_timestamp"))


def run_folder(lake: Lake, folder: str, columns, dim_date: DataFrame, catalog: str = "hr", as_of: Column | None = None, serving=None,
               archive_to: str | None = None, suffix: str = ".csv") -> bool:
    """All report extracts of a folder in one scan, dated by their own headings; False without files.

    ``columns``: cleaned column names in file order.  Rows of an extract whose heading has no date are refused.
    """
    paths = [r.path for r in list_files(lake.spark, folder, suffix).select("path").collect()]
    if not paths:
        return False
    rows = stage(read_sheets(lake.spark, paths, columns, dates=lambda line: parse_date(report_date_text(line))), "reports")
    undated = rows.where("report_date is null").select("SourceSheet").distinct().limit(5).collect()
    if undated:
        raise ValueError(f"no report date in the heading of {[r.SourceSheet for r in undated]}")
    run(lake, rows, F.col("report_date"), dim_date, catalog, as_of, serving)
    archive(lake, paths, folder, archive_to)
    return True


def run(lake: Lake, report: DataFrame, report_date: Column, dim_date: DataFrame, catalog: str = "hr",
        as_of: Column | None = None, serving=None) -> None:
    """Report rows to bronze; their dates are replaced in silver, gold and serving, so ingesting them again adds no duplicates."""
    batch = bronze_rows(report, report_date)
    lake.write_bronze(batch, f"{catalog}.bronze.biometric_raw", as_of)
    bronze = lake.read(f"{catalog}.bronze.biometric_raw", evolving=True)
    lake.replace_partitions(silver(bronze, batch), f"{catalog}.silver.biometric_cleaned", "work_date")
    cleaned = in_batch_dates(lake.read(f"{catalog}.silver.biometric_cleaned"),
                             batch.select(F.col("ingest_work_date").alias("work_date")), "work_date")
    facts = gold(cleaned, lake.read(f"{catalog}.gold.dim_employee"), dim_date, as_of)
    lake.replace_partitions(facts, f"{catalog}.gold.fact_attendance_biometric", "work_date")
    if serving is not None:
        serving.replace_dates(facts, "fact_attendance_biometric", "work_date")
