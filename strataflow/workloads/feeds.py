"""Whole feeds: raw lines to facts and dimension, each over a full table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import dims, scd
from ..operators.layout import shared_folder
from ..plans import attendance, biometric, employee, incremental, leave, timesheet
from ..sources.lake import CLOSED_BATCH, Lake
from .cleaning import STAMP, stamp
from .dimensions import FIRST_LOAD, SECOND_LOAD, employees
from .nested import money, nested_json, polymorphic_lines, text
from .registry import REGISTRY, query


def micros_after(column, micros):
    return F.timestamp_micros(F.unix_micros(F.col(column).cast("timestamp")) + micros)


ATTENDANCE_SQL = """
    WITH e AS (
        SELECT *, CAST(ts AS DATE) AS d FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC) = 1)
    SELECT c_custkey AS dim_employee_key, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS dim_date_key,
           CASE WHEN event_type IN ('click', 'view') THEN strftime(d, '%d-%b-%Y') ELSE strftime(d, '%Y-%m-%d') END AS work_date_str,
           CASE WHEN event_type IN ('click', 'view') THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS first_in_ts,
           CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS last_out_ts,
           CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS work_minutes,
           CASE WHEN event_type <> 'error' THEN CAST(minute(ts) * 60 + second(ts) AS INTEGER) END AS total_minutes,
           CASE WHEN event_type <> 'signup' THEN user_id END AS ercno, event_type AS zoho_status,
           strftime(d, '%Y-%m-%d') AS work_date
    FROM e JOIN customer ON c_custkey = user_id AND c_acctbal >= 0
"""


def attendance_lines(t):
    """Events as attendance lines, in all three nestings and all accepted time formats."""
    kind = F.col("event_type")
    spelled = kind.isin("click", "view")
    record = F.struct(
        F.when(spelled, F.date_format("ts", "dd-MMM-yyyy")).otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("Date"),
        F.when(spelled, F.date_format("ts", "dd-MMM-yyyy hh:mm a")).when(kind == "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", STAMP)).alias("FirstIn"),
        F.when(kind != "error", F.date_format("ts", STAMP)).alias("LastOut"),
        F.when(kind != "error", F.date_format("ts", "mm:ss")).otherwise(F.lit("none")).alias("TotalHours"),
        text("user_id").alias("employee_id"),
        F.when(kind == "signup", F.concat(F.lit("X"), text("user_id"))).otherwise(text("user_id")).alias("ercno"),
        F.date_format("ts", "HH:mm").alias("working_hour"), kind.alias("Status"))
    result = F.array(record)
    line = F.when(kind == "error", nested_json(result)).when(kind == "view", nested_json(result, "_airbyte_data")) \
        .otherwise(nested_json(result, "_airbyte_data", "response", "result"))
    return t.spread("events").select(line.alias("raw_json"), F.col("ts").cast("timestamp").alias("ingest_timestamp"))


@query("fact_attendance", ATTENDANCE_SQL)
def fact_attendance(t):
    cleaned = attendance.silver(attendance_lines(t))
    return attendance_columns(attendance.gold(cleaned, employees(t), dims.date_dimension(t.events, "ts")))


def attendance_columns(facts):
    return facts.select("dim_employee_key", "dim_date_key", "work_date_str", stamp("first_in_ts").alias("first_in_ts"),
                        stamp("last_out_ts").alias("last_out_ts"), "work_minutes", "total_minutes", "ercno", "zoho_status",
                        F.col("work_date").cast("string").alias("work_date"))


@query("fact_attendance_biometric", """
    WITH o AS (
        SELECT *, CAST(floor(o_totalprice) AS BIGINT) % 1440 AS m FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1)
    SELECT c_custkey AS dim_employee_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS dim_date_key,
           CAST(o_custkey AS VARCHAR) AS source_bio_id, o_orderpriority AS name_in_bio, o_orderstatus AS bio_status,
           CAST(m AS INTEGER) AS work_minutes, CASE WHEN o_orderstatus <> 'P' THEN CAST(m AS INTEGER) END AS total_minutes,
           CAST(NULL AS INTEGER) AS ot_minutes, strftime(o_orderdate, '%Y-%m-%d') AS work_date
    FROM o JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
""")
def fact_attendance_biometric(t):
    minutes = F.floor("o_totalprice").cast("bigint") % 1440
    clock = F.format_string("%02d:%02d", F.floor(minutes / 60), minutes % 60)
    report = t.spread("orders").select(
        text("o_custkey").alias("E. Code"), F.col("o_orderpriority").alias("EmpName"), F.lit("GS").alias("Shift"),
        clock.alias("A.InTime"), clock.alias("A OutTime"), clock.alias("Work Dur."), F.lit("--").alias("OT"),
        F.when(F.col("o_orderstatus") != "P", clock).otherwise(F.lit("0800")).alias("Tot.  Dur."),
        F.col("o_orderstatus").alias("Status"), F.col("o_orderdate").alias("day"), F.col("o_orderkey").alias("seq"))
    raw = biometric.bronze_rows(report, F.col("day")).withColumn("ingest_timestamp", F.timestamp_seconds("seq"))
    facts = biometric.gold(biometric.silver(raw), employees(t), dims.date_dimension(t.orders, "o_orderdate"))
    return facts.select("dim_employee_key", "dim_date_key", "source_bio_id", "name_in_bio", "bio_status", "work_minutes",
                        "total_minutes", "ot_minutes", F.col("work_date").cast("string").alias("work_date"))


def leave_lines(t):
    """Orders as leave requests of two days, bookkeeping entries included, in three nestings."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")

    def leave_day(start, count):
        return F.struct(start.alias("StartTime"), F.lit("18:00:00").alias("EndTime"), F.lit(count).alias("LeaveCount"),
                        F.lit("Full Day").alias("Session"))
    start = F.when(status == "F", F.lit("09:00:00")).when(status == "O", F.date_format("o_orderdate", STAMP)).otherwise(F.lit("09:00"))
    days = F.create_map(day, leave_day(start, "1.0"), F.concat(day, F.lit("b")), leave_day(F.lit("10:00:00"), "0.5"))
    record = F.to_json(F.struct(
        text("o_custkey").alias("EmployeeId"), F.col("o_orderkey").alias("Zoho.ID"), status.alias("ApprovalStatus"),
        F.date_format("o_orderdate", "dd-MMM-yyyy").alias("From"), day.alias("To"), F.col("o_orderpriority").alias("Leavetype"),
        F.col("o_custkey").alias("ZUID"), F.lit("trip").alias("Reason"), days.alias("Days")))
    body = F.concat(F.lit('{"status":0,"rec'), text("o_orderkey"), F.lit('":'), record, F.lit(',"message":"ok"}'))
    line = F.when(status == "F", F.concat(F.lit('{"_airbyte_data":{"response":{"result":'), body, F.lit("}}}"))) \
        .when(status == "O", F.concat(F.lit('{"response":{"result":'), body, F.lit("}}"))) \
        .otherwise(F.concat(F.lit('{"result":'), body, F.lit("}")))
    return t.spread("orders").select(line.alias("raw_json"), F.col("o_orderdate").cast("timestamp").alias("ingest_timestamp"))


@query("fact_leave", """
    SELECT c_custkey AS dim_employee_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS dim_date_key,
           o_orderkey AS source_leave_id, 'rec' || o_orderkey AS zoho_record_id, o_orderstatus AS approval_status,
           strftime(o_orderdate, '%Y-%m-%d') AS from_date, strftime(o_orderdate, '%Y-%m-%d') AS to_date,
           o_orderpriority AS leave_type, o_custkey AS zuid_in_leave,
           CASE o_orderstatus WHEN 'F' THEN '09:00:00' WHEN 'O' THEN '00:00:00' END AS leave_start_time,
           '18:00:00' AS leave_end_time, CAST(1.0 AS DOUBLE) AS leave_count
    FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
""")
def fact_leave(t):
    return leave_columns(leave.gold(leave.silver(leave_lines(t)), employees(t), dims.date_dimension(t.orders, "o_orderdate")))


def leave_columns(facts):
    return facts.select("dim_employee_key", "dim_date_key", "source_leave_id", "zoho_record_id", "approval_status",
                        F.col("from_date").cast("string").alias("from_date"), F.col("to_date").cast("string").alias("to_date"),
                        "leave_type", "zuid_in_leave", "leave_start_time", "leave_end_time",
                        F.col("leave_count").cast("double").alias("leave_count"))


@query("leave_days_exploded", """
    SELECT o_orderkey AS source_leave_id, strftime(o_orderdate, '%Y-%m-%d') || s AS leave_day, n AS leave_count
    FROM orders, (VALUES ('', CAST(1.0 AS DOUBLE)), ('b', CAST(0.5 AS DOUBLE))) AS days(s, n)
""")
def leave_days_exploded(t):
    rows = leave.silver(leave_lines(t), explode_days=True)
    return rows.select("source_leave_id", "leave_day", F.col("leave_count").cast("double").alias("leave_count"))


@query("fact_timesheet", """
    WITH l AS (
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey * 1000000 + l_suppkey DESC) = 1)
    SELECT s_suppkey AS dim_employee_key, CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS dim_date_key,
           l_orderkey || '-' || l_linenumber AS timelog_id, CAST(NULL AS INTEGER) AS source_log_id,
           CAST(l_quantity AS INTEGER) AS minutes_int, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS TINYINT) AS is_edit_allowed,
           CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS TINYINT) AS timer_log, l_returnflag AS job_name,
           l_orderkey AS from_time_bigint, strftime(l_shipdate, '%Y-%m-%d') AS work_date
    FROM l JOIN supplier ON s_suppkey = l_suppkey AND s_acctbal >= 0
""")
def fact_timesheet(t):
    return timesheet_columns(timesheet.gold(timesheet.silver(timesheet_lines(t)), staff(t), dims.date_dimension(t.lineitem, "l_shipdate")))


def timesheet_lines(t):
    """Order lines as time logs."""
    log = F.to_json(F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("timelogId"), F.date_format("l_shipdate", "dd-MMM-yyyy").alias("workDate"),
        F.col("l_quantity").cast("int").alias("hoursInMins"), (F.col("l_returnflag") == "R").alias("isEditAllowed"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("timerLog"), F.col("l_returnflag").alias("jobName"),
        F.col("l_orderkey").alias("fromTime"), F.concat(F.lit("s"), text("l_suppkey"), F.lit("@corp.example")).alias("employeeMailId")))
    return t.spread("lineitem").select(nested_json(F.array(log), "response", "result").alias("raw_json"),
                                       micros_after("l_shipdate", F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("ingest_timestamp"))


def staff(t):
    """Suppliers as employees with mail addresses."""
    return t.supplier.select(F.col("s_suppkey").alias("dim_employee_key"), text("s_suppkey").alias("employee_id"),
                             F.concat(F.lit("s"), text("s_suppkey"), F.lit("@corp.example")).alias("email_id"),
                             F.when(F.col("s_acctbal") >= 0, 1).otherwise(0).alias("is_current"))


def timesheet_columns(facts):
    return facts.select("dim_employee_key", "dim_date_key", "timelog_id", "source_log_id", "minutes_int", "is_edit_allowed",
                        "timer_log", "job_name", "from_time_bigint", F.col("work_date").cast("string").alias("work_date"))


@query("dim_employee", f"""
    WITH versions AS (
        SELECT c_custkey, c_name, c_mktsegment AS department, '{FIRST_LOAD}' AS valid_from,
               CASE WHEN c_acctbal < 0 THEN '{SECOND_LOAD}' END AS valid_to FROM customer
        UNION ALL
        SELECT c_custkey, c_name, 'ARREARS', '{SECOND_LOAD}', NULL FROM customer WHERE c_acctbal < 0)
    SELECT CAST(c_custkey AS VARCHAR) AS employee_id, c_name AS full_name, department, valid_from, valid_to,
           CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_current
    FROM versions
""")
def dim_employee(t):
    """Two loads of the employee feed; in the second the department of indebted customers changed."""
    def snapshot(customers, when):
        lines = polymorphic_lines(customers).select("raw_json", F.lit(when).cast("timestamp").alias("ingest_timestamp"))
        return employee.silver(lines)

    first = snapshot(t.spread("customer"), FIRST_LOAD)
    # The record is changed inside the JSON text, so the payload shapes of the second load stay as they are.
    lines = polymorphic_lines(t.spread("customer"))
    moved = F.when(F.col("c_acctbal") < 0, F.regexp_replace("raw_json", '"Department":"[A-Z]+"', '"Department":"ARREARS"')) \
        .otherwise(F.col("raw_json"))
    second = employee.silver(lines.select(moved.alias("raw_json"), F.lit(SECOND_LOAD).cast("timestamp").alias("ingest_timestamp")))
    history = scd.apply_snapshot(scd.first_history(first, "dim_employee_key"), first, "employee_id",
                                 F.lit(FIRST_LOAD).cast("timestamp"), surrogate="dim_employee_key")
    history = scd.apply_snapshot(history, second, "employee_id", F.lit(SECOND_LOAD).cast("timestamp"), surrogate="dim_employee_key")
    return history.select("employee_id", "full_name", "department", stamp("valid_from").alias("valid_from"),
                          stamp("valid_to").alias("valid_to"), "is_current")


@query("fact_orders", """
    SELECT c_custkey AS dim_employee_key, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS dim_date_key, o_orderkey AS order_id,
           o_totalprice AS amount, strftime(o_orderdate, '%Y-%m-%d') AS work_date
    FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
    QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1
""")
def fact_orders(t):
    """Raw order lines, decoded, cleaned, latest per customer and day, keyed to both dimensions."""
    from ..functions import payload as P
    from ..functions.casts import to_decimal, to_long
    from ..functions.temporal import parse_date
    from ..operators.latest import keep_latest
    record = F.struct(text("o_orderkey").alias("id"), text("o_custkey").alias("employee_id"), money("o_totalprice").alias("amount"),
                      F.date_format("o_orderdate", "dd-MMM-yyyy").alias("Date"))
    lines = t.spread("orders").select(nested_json(F.array(record), "_airbyte_data", "response", "result").alias("raw_json"))
    rows = P.explode_structs(lines, P.locate(F.col("raw_json"), P.ATTENDANCE_PATHS, True),
                             P.struct_ddl(("id", "employee_id", "amount", "Date")))
    typed = rows.select(to_long(F.col("record.id")).alias("order_id"), "record.employee_id", parse_date(F.col("record.Date")).alias("work_date"),
                        to_decimal(F.col("record.amount"), 12, 2).alias("amount")).filter(F.col("work_date").isNotNull())
    latest = keep_latest(typed, ["employee_id", "work_date"], ["order_id"], tie_break=False)
    facts = dims.resolved(dims.enrich(latest, employees(t), dims.date_dimension(t.orders, "o_orderdate")))
    return facts.select("dim_employee_key", "dim_date_key", "order_id", F.col("amount").cast("double").alias("amount"),
                        F.col("work_date").cast("string").alias("work_date"))


def own_lake(t):
    """A lake of the query's own in the shared folder, deleted when the application ends."""
    lake = Lake(t.spark, f"{shared_folder(t.spark)}/lakes/{uuid.uuid4().hex}")
    fs, path = lake._file_system(lake.base)
    fs.deleteOnExit(path)
    return lake


def loaded_twice(t, feed, lines, people, dates):
    """Facts of a feed whose lines come in two batches; half of the people, too, are known only when the second one comes."""
    lake = own_lake(t)
    half = F.pmod(F.xxhash64("raw_json"), F.lit(2))
    for k in range(2):
        lake.write_bronze(lines.where(half == k), feed.bronze, F.col("ingest_timestamp"), align=False, batch=f"load-{k}")
        known = people if k else people.where(F.pmod(F.xxhash64("dim_employee_key"), F.lit(2)) == 0)
        incremental.load_new(lake, feed, known, dates)
    return lake.read(feed.gold)


@query("fact_attendance_loads", ATTENDANCE_SQL)
def fact_attendance_loads(t):
    """As fact_attendance, in two incremental loads."""
    feed = attendance.feed(period="year")
    return attendance_columns(loaded_twice(t, feed, attendance_lines(t), employees(t), dims.date_dimension(t.events, "ts")))


@query("fact_leave_loads", REGISTRY["fact_leave"].sql)
def fact_leave_loads(t):
    """As fact_leave, in two incremental loads."""
    return leave_columns(loaded_twice(t, leave.feed(period="year"), leave_lines(t), employees(t), dims.date_dimension(t.orders, "o_orderdate")))


@query("fact_timesheet_loads", REGISTRY["fact_timesheet"].sql)
def fact_timesheet_loads(t):
    """As fact_timesheet, in two incremental loads: time logs of one id that stand at several dates, in both of them."""
    feed = timesheet.feed(period="year")
    return timesheet_columns(loaded_twice(t, feed, timesheet_lines(t), staff(t), dims.date_dimension(t.lineitem, "l_shipdate")))


@query("dim_employee_loads", REGISTRY["dim_employee"].sql)
def dim_employee_loads(t):
    """As dim_employee, in two incremental loads; the second has the changed records only, and the others are left as they are."""
    lake, lines = own_lake(t), polymorphic_lines(t.spread("customer"))
    moved = lines.where("c_acctbal < 0").select(F.regexp_replace("raw_json", '"Department":"[A-Z]+"', '"Department":"ARREARS"').alias("raw_json"))
    for batch, when in ((lines.select("raw_json"), FIRST_LOAD), (moved, SECOND_LOAD)):
        lake.write_bronze(batch, "hr.bronze.employee_raw", F.lit(when).cast("timestamp"), align=False, batch=f"load-{when[:10]}")
        employee.load(lake, as_of=F.lit(when).cast("timestamp"))
    history = lake.read("hr.gold.dim_employee").drop(CLOSED_BATCH)
    return history.select("employee_id", "full_name", "department", stamp("valid_from").alias("valid_from"),
                          stamp("valid_to").alias("valid_to"), "is_current")
