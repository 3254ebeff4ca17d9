"""Attendance feed to a fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import payload as P
from ..functions.casts import to_long
from ..functions.temporal import clock_to_minutes, parse_date, parse_timestamp
from ..operators.cleaning import require
from ..operators.dims import enrich, resolved
from ..operators.latest import keep_latest
from ..operators.upsert import within_keys
from ..sources.lake import Lake
from .incremental import Feed, load_new
from .intake import archive, take_in

# Source fields and their warehouse names; the fact's columns.
FIELDS = {
    "Date": "work_date_str",
    "DeviationTime": "deviation_time",
    "FirstIn": "first_in",
    "FirstIn_Building": "first_in_building",
    "FirstIn_Location": "first_in_location",
    "LastOut": "last_out",
    "LastOut_Building": "last_out_building",
    "LastOut_Location": "last_out_location",
    "ShiftEndTime": "shift_end_time_str",
    "ShiftName": "shift_name",
    "Status": "zoho_status",
    "TotalHours": "zoho_total_hours_str",
    "email": "email",
    "employee_id": "employee_id",
    "ercno": "ercno",
    "shifttime": "shifttime_str",
    "working_hour": "zoho_working_hour_str",
}
FACT_COLUMNS = (
    "dim_employee_key", "dim_date_key", "source_attendance_id", "work_date_str", "deviation_time", "first_in_building",
    "first_in_location", "last_out_building", "last_out_location", "shift_end_time_str", "shift_name", "zoho_status",
    "zoho_total_hours_str", "zoho_working_hour_str", "ercno", "shifttime_str", "first_in_ts", "last_out_ts",
    "work_minutes", "total_minutes")


def decode(bronze: DataFrame) -> DataFrame:
    line = F.col("raw_json")
    payload = P.locate(line, P.ATTENDANCE_PATHS, or_whole_line=True)
    rows = P.explode_structs(bronze, payload, P.struct_ddl(FIELDS), "ingest_timestamp",
                             F.get_json_object(line, P.WRAPPER_ID).alias("source_attendance_id"))
    return rows.select("ingest_timestamp", "source_attendance_id", *P.renamed("record", FIELDS))


def silver(bronze: DataFrame, keep_ingest: bool = False) -> DataFrame:
    """Typed attendance, the latest row per employee and date; ``keep_ingest`` leaves the ingest time in, for later merges."""
    typed = decode(bronze).withColumns({
        "ercno": to_long(F.col("ercno")),
        "first_in_ts": parse_timestamp(F.col("first_in")),
        "last_out_ts": parse_timestamp(F.col("last_out")),
        "work_date": parse_date(F.col("work_date_str")),
    }).drop("first_in", "last_out")
    dated = require(typed, "work_date").withColumns({
        "work_minutes": clock_to_minutes(F.col("zoho_working_hour_str")),
        "total_minutes": clock_to_minutes(F.col("zoho_total_hours_str"))})
    latest = keep_latest(dated, ["employee_id", "work_date"], ["ingest_timestamp"])
    return latest if keep_ingest else latest.drop("ingest_timestamp")


def gold(silver_df: DataFrame, dim_employee: DataFrame, dim_date: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The fact; ``work_date`` is kept beside its columns as the partition key."""
    facts = resolved(enrich(silver_df, dim_employee, dim_date))
    stamped = facts.withColumns({"source_attendance_id": F.xxhash64("source_attendance_id"),
                                 "dw_load_timestamp": F.current_timestamp() if as_of is None else as_of})
    return stamped.select(*FACT_COLUMNS, "dw_load_timestamp", "work_date")


def feed(catalog: str = "hr", as_of: Column | None = None, period: str | None = None) -> Feed:
    """The tables and steps of this feed."""
    return Feed(f"{catalog}.bronze.attendance_raw", f"{catalog}.silver.attendance_cleaned", f"{catalog}.gold.fact_attendance",
                ("employee_id", "work_date"), "work_date", lambda df: silver(df, keep_ingest=True),
                lambda df, people, dates: gold(df, people, dates, as_of), period=period)


def run(lake: Lake, folder: str, dim_date: DataFrame, catalog: str = "hr", as_of: Column | None = None, serving=None,
        archive_to: str | None = None, once: bool = False) -> bool:
    """Files to bronze, silver and gold; then the serving table's dates are replaced if one is given.  False without files."""
    paths = take_in(lake, folder, f"{catalog}.bronze.attendance_raw", as_of, once=once)
    if not paths:
        return False
    parts = load_new(lake, feed(catalog, as_of), lake.read(f"{catalog}.gold.dim_employee"), dim_date)
    if serving is not None and parts is not None:
        facts = lake.read(f"{catalog}.gold.fact_attendance")
        serving.replace_dates(within_keys(facts, parts.withColumnRenamed("_part", "work_date"), "work_date"), "fact_attendance", "work_date")
    archive(lake, paths, folder, archive_to)
    return True
