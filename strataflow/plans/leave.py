"""Leave feed to a fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import payload as P
from ..functions.casts import to_decimal, to_long
from ..functions.temporal import parse_date, time_of_day
from ..operators.cleaning import require
from ..operators.dims import enrich, resolved
from ..operators.latest import keep_latest
from ..operators.upsert import within_keys
from ..sources.lake import Lake
from .incremental import Feed, load_new
from .intake import archive, take_in

# Record layout and the fact's columns.
DAY_FIELDS = ("StartTime", "EndTime", "LeaveCount", "Session")
RECORD = ("STRUCT<EmployeeId: STRING, `Zoho.ID`: STRING, ApprovalStatus: STRING, DateOfRequest: STRING, `From`: STRING, "
          "`To`: STRING, Leavetype: STRING, TeamEmailID: STRING, Unit: STRING, ZUID: STRING, Reason: STRING, "
          f"Days: MAP<STRING, {P.struct_ddl(DAY_FIELDS)}>>")
FACT_COLUMNS = (
    "dim_employee_key", "dim_date_key", "source_leave_id", "zoho_record_id", "approval_status", "date_of_request",
    "from_date", "to_date", "leave_type", "team_email_id", "leave_unit", "zuid_in_leave", "reason",
    "leave_start_time", "leave_end_time", "leave_count")


def decode(bronze: DataFrame) -> DataFrame:
    payload = P.locate(F.col("raw_json"), P.LEAVE_PATHS)
    records = P.explode_map_records(bronze, payload, RECORD, "ingest_timestamp", key="zoho_record_id", alias="r")
    return records.select("ingest_timestamp", "zoho_record_id", "r.*").filter(F.col("EmployeeId").isNotNull())


def silver(bronze: DataFrame, explode_days: bool = False, keep_ingest: bool = False) -> DataFrame:
    """Typed leave, latest per leave id.

    A multi-day leave contributes its first day; ``explode_days`` gives one row per day instead.  ``keep_ingest`` leaves the
    ingest time in, for later merges.
    """
    decoded = decode(bronze)
    if explode_days:
        decoded = decoded.select("*", F.explode_outer("Days").alias("leave_day", "day"))
    else:
        decoded = decoded.withColumn("day", P.first_map_value(F.col("Days")))
    typed = decoded.select(
        "ingest_timestamp", F.col("EmployeeId").alias("employee_id"), to_long(F.col("`Zoho.ID`")).alias("source_leave_id"),
        "zoho_record_id", F.col("ApprovalStatus").alias("approval_status"),
        parse_date(F.col("DateOfRequest")).alias("date_of_request"), parse_date(F.col("From")).alias("from_date"),
        parse_date(F.col("To")).alias("to_date"), F.col("Leavetype").alias("leave_type"),
        F.col("TeamEmailID").alias("team_email_id"), F.col("Unit").alias("leave_unit"),
        to_long(F.col("ZUID")).alias("zuid_in_leave"), F.col("Reason").alias("reason"),
        time_of_day(F.col("day.StartTime")).alias("leave_start_time"),
        time_of_day(F.col("day.EndTime")).alias("leave_end_time"),
        to_decimal(F.col("day.LeaveCount"), 4, 1).alias("leave_count"),
        *(["leave_day"] if explode_days else []))
    keys = ["source_leave_id", "leave_day"] if explode_days else ["source_leave_id"]
    latest = keep_latest(require(typed, "employee_id", "from_date"), keys, ["ingest_timestamp"])
    return latest if keep_ingest else latest.drop("ingest_timestamp")


def gold(silver_df: DataFrame, dim_employee: DataFrame, dim_date: DataFrame, as_of: Column | None = None) -> DataFrame:
    facts = resolved(enrich(silver_df, dim_employee, dim_date, date_col="from_date"))
    stamp = F.current_timestamp() if as_of is None else as_of
    return facts.select(*FACT_COLUMNS, stamp.alias("dw_load_timestamp"))


def feed(catalog: str = "hr", as_of: Column | None = None, period: str | None = None) -> Feed:
    """The tables and steps of this feed."""
    return Feed(f"{catalog}.bronze.leave_raw", f"{catalog}.silver.leave_cleaned", f"{catalog}.gold.fact_leave", ("source_leave_id",),
                "from_date", lambda df: silver(df, keep_ingest=True), lambda df, people, dates: gold(df, people, dates, as_of), period=period)


def run(lake: Lake, folder: str, dim_date: DataFrame, catalog: str = "hr", as_of: Column | None = None, serving=None,
        archive_to: str | None = None, once: bool = False) -> bool:
    """Files to bronze, silver and gold; rows new to the serving table are added if one is given.  False without files."""
    paths = take_in(lake, folder, f"{catalog}.bronze.leave_raw", as_of, once=once)
    if not paths:
        return False
    parts = load_new(lake, feed(catalog, as_of), lake.read(f"{catalog}.gold.dim_employee"), dim_date)
    if serving is not None and parts is not None:
        serving.insert_absent(within_keys(lake.read(f"{catalog}.gold.fact_leave"), parts.withColumnRenamed("_part", "from_date"), "from_date"),
                              "fact_leave", "source_leave_id")
    archive(lake, paths, folder, archive_to)
    return True
