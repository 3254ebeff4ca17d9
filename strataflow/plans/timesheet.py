"""Timesheet feed to a fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import payload as P
from ..functions.casts import to_flag, to_int, to_long
from ..functions.temporal import parse_date
from ..operators.cleaning import require
from ..operators.dims import enrich, resolved
from ..operators.latest import keep_latest
from ..operators.upsert import within_keys
from ..sources.lake import Lake
from .incremental import Feed, load_new
from .intake import archive, take_in

# Source field -> (warehouse name, type).
FIELDS = {
    "approvalStatus": ("log_approval_status", "text"),
    "billedStatus": ("billed_status", "text"),
    "billingStatus": ("billing_status", "text"),
    "clientId": ("client_id", "text"),
    "description": ("description", "text"),
    "erecno": ("erecno", "text"),
    "fromTime": ("from_time_bigint", "long"),
    "fromTimeInTimeFormat": ("from_time_str", "text"),
    "hours": ("hours_str", "text"),
    "hoursInMins": ("minutes_int", "int"),
    "isDeleteAllowed": ("is_delete_allowed", "flag"),
    "isEditAllowed": ("is_edit_allowed", "flag"),
    "isPushAllowToZF": ("is_push_to_zf", "flag"),
    "isPushAllowToZP": ("is_push_to_zp", "flag"),
    "isTimelogPushedToQBO": ("is_pushed_to_qbo", "flag"),
    "jobBillableStatus": ("job_billable_status", "text"),
    "jobColor": ("job_color", "text"),
    "jobId": ("job_id", "text"),
    "jobIsActive": ("job_is_active", "flag"),
    "jobIsCompleted": ("job_is_completed", "int"),
    "jobName": ("job_name", "text"),
    "projectId": ("project_id", "text"),
    "projectName": ("project_name", "text"),
    "taskName": ("task_name", "text"),
    "timelogId": ("timelog_id", "text"),
    "timerLog": ("timer_log", "flag"),
    "toTime": ("to_time_bigint", "long"),
    "toTimeInTimeFormat": ("to_time_str", "text"),
    "totaltime": ("total_time_bigint", "long"),
    "tt_inputType": ("tt_input_type", "int"),
    "type": ("type_col", "text"),
}
KEPT_AS_TEXT = ("workDate", "employeeMailId")
FACT_COLUMNS = ("dim_employee_key", "dim_date_key", "source_log_id") + tuple(name for name, _ in FIELDS.values()) + ("work_date",)

_CASTS = {"text": lambda c: c, "long": to_long, "int": to_int, "flag": to_flag}


def silver(bronze: DataFrame, keep_ingest: bool = False) -> DataFrame:
    """Typed time logs, latest per log id.  Each log text is parsed once, whatever the number of fields.

    ``keep_ingest`` leaves the ingest time in, for later merges.
    """
    payload = P.locate(F.col("raw_json"), P.TIMESHEET_PATHS)
    layout = P.struct_ddl(list(FIELDS) + list(KEPT_AS_TEXT))
    logs = P.explode_records(bronze, F.from_json(payload, "ARRAY<STRING>"), layout, "ingest_timestamp", alias="r")
    typed = logs.select("ingest_timestamp",
                        *[_CASTS[kind](F.col(f"r.`{source}`")).alias(name) for source, (name, kind) in FIELDS.items()],
                        parse_date(F.col("r.workDate")).alias("work_date"), F.col("r.employeeMailId").alias("email"),
                        to_int(F.col("r.timelogId")).alias("source_log_id"))
    latest = keep_latest(require(typed, "work_date"), ["timelog_id"], ["ingest_timestamp"])
    return latest if keep_ingest else latest.drop("ingest_timestamp")


def gold(silver_df: DataFrame, dim_employee: DataFrame, dim_date: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Employees are found by e-mail: time logs carry no employee id."""
    facts = resolved(enrich(silver_df, dim_employee, dim_date, employee_col=None))
    stamp = F.current_timestamp() if as_of is None else as_of
    return facts.select(*FACT_COLUMNS, stamp.alias("dw_load_timestamp"))


def feed(catalog: str = "hr", as_of: Column | None = None, period: str | None = None) -> Feed:
    """The tables and steps of this feed."""
    return Feed(f"{catalog}.bronze.timesheet_raw", f"{catalog}.silver.timesheet_cleaned", f"{catalog}.gold.fact_timesheet", ("timelog_id",),
                "work_date", lambda df: silver(df, keep_ingest=True), lambda df, people, dates: gold(df, people, dates, as_of),
                person="email", person_key="email_id", period=period)


def run(lake: Lake, folder: str, dim_date: DataFrame, catalog: str = "hr", as_of: Column | None = None, serving=None,
        archive_to: str | None = None, once: bool = False) -> bool:
    """Files to bronze, silver and gold; rows new to the serving table are added if one is given.  False without files."""
    paths = take_in(lake, folder, f"{catalog}.bronze.timesheet_raw", as_of, once=once)
    if not paths:
        return False
    parts = load_new(lake, feed(catalog, as_of), lake.read(f"{catalog}.gold.dim_employee"), dim_date)
    if serving is not None and parts is not None:
        serving.insert_absent(within_keys(lake.read(f"{catalog}.gold.fact_timesheet"), parts.withColumnRenamed("_part", "work_date"), "work_date"),
                              "fact_timesheet", "timelog_id")
    archive(lake, paths, folder, archive_to)
    return True
