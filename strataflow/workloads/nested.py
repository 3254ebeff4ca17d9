"""JSON decoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import payload as P
from ..functions.casts import to_decimal, to_int, to_long
from ..functions.temporal import parse_date
from ..operators.runs import flatten_job_settings, flatten_nested, flatten_runs, notification_ids
from .registry import query


def text(c):
    return F.col(c).cast("string")


def money(c):
    return F.col(c).cast("decimal(12,2)").cast("string")


def nest(value, *names):
    """Wrap a value into nested one-field structs, outermost name first."""
    for name in reversed(names):
        value = F.struct(value.alias(name))
    return value


def nested_json(value, *names):
    return F.to_json(nest(value, *names)) if names else F.to_json(value)


@query("json_array_struct_explode", """
    SELECT o_orderkey AS order_id, o_custkey AS cust_id, 'price' AS kind, o_totalprice AS amount FROM orders
    UNION ALL
    SELECT o_orderkey, o_custkey, 'priority', NULL FROM orders
""")
def json_array_struct_explode(t):
    def entry(kind, value):
        return F.struct(text("o_orderkey").alias("Id"), text("o_custkey").alias("Cust"), F.lit(kind).alias("Kind"),
                        value.alias("Amount"))
    result = F.array(entry("price", money("o_totalprice")), entry("priority", F.col("o_orderpriority")))
    status = F.col("o_orderstatus")
    lines = t.spread("orders").select(
        F.when(status == "F", nested_json(result, "_airbyte_data", "response", "result"))
        .when(status == "O", nested_json(result, "_airbyte_data"))
        .otherwise(nested_json(result)).alias("raw_json"))
    payload = P.locate(F.col("raw_json"), P.ATTENDANCE_PATHS, or_whole_line=True)
    rows = P.explode_structs(lines, payload, P.struct_ddl(("Id", "Cust", "Kind", "Amount")))
    return rows.select(to_long(F.col("record.Id")).alias("order_id"), to_long(F.col("record.Cust")).alias("cust_id"),
                       F.col("record.Kind").alias("kind"),
                       to_decimal(F.col("record.Amount"), 12, 2).cast("double").alias("amount"))


@query("json_string_array_project", """
    SELECT l_orderkey AS order_id, l_linenumber AS line_no, CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice AS price,
           strftime(l_shipdate, '%Y-%m-%d') AS ship_date
    FROM lineitem
""")
def json_string_array_project(t):
    log = F.to_json(F.struct(
        text("l_orderkey").alias("id"), text("l_linenumber").alias("line"),
        F.col("l_quantity").cast("int").cast("string").alias("qty"), money("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", "dd-MMM-yyyy").alias("date")))
    lines = t.spread("lineitem").select(nested_json(F.array(log), "response", "result").alias("raw_json"))
    texts = P.explode_texts(lines, P.locate(F.col("raw_json"), P.TIMESHEET_PATHS))
    logs = texts.select(F.from_json("record_json", P.struct_ddl(("id", "line", "qty", "price", "date"))).alias("r"))
    return logs.select(to_long(F.col("r.id")).alias("order_id"), to_int(F.col("r.line")).alias("line_no"),
                       to_int(F.col("r.qty")).alias("quantity"),
                       to_decimal(F.col("r.price"), 12, 2).cast("double").alias("price"),
                       parse_date(F.col("r.date")).cast("string").alias("ship_date"))


@query("json_map_explode", """
    SELECT 'id_' || c_custkey AS record_id, c_name AS name, c_mktsegment AS segment, c_nationkey AS nation FROM customer
""")
def json_map_explode(t):
    record = F.to_json(F.struct("c_name", "c_mktsegment", "c_nationkey"))
    body = F.concat(F.lit('{"status":0,"id_'), text("c_custkey"), F.lit('":'), record,
                    F.lit(',"message":"ok","total_count":"1"}'))
    lines = t.customer.select(F.concat(F.lit('{"result":'), body, F.lit("}")).alias("raw_json"))
    rows = P.explode_map(lines, P.locate(F.col("raw_json"), P.LEAVE_PATHS))
    decoded = rows.select("record_id", F.from_json("record_json", "STRUCT<c_name: STRING, c_mktsegment: STRING, c_nationkey: INT>").alias("r"))
    return decoded.select("record_id", F.col("r.c_name").alias("name"), F.col("r.c_mktsegment").alias("segment"),
                          F.col("r.c_nationkey").alias("nation"))


def polymorphic_lines(customers):
    """Each customer as an employee payload; the market segment decides the shape."""
    record = F.struct(text("c_custkey").alias("EmployeeID"), F.col("c_name").alias("FirstName"),
                      F.col("c_mktsegment").alias("Department"))
    one = F.to_json(record)
    listed = F.to_json(F.array(record))
    keyed = F.concat(F.lit('{"k'), text("c_custkey"), F.lit('":'))
    segment = F.col("c_mktsegment")
    return customers.select(
        "*",
        F.when(segment == "BUILDING", one)
        .when(segment == "MACHINERY", listed)
        .when(segment == "FURNITURE", F.concat(F.lit("["), keyed, listed, F.lit("}]")))
        .when(segment == "HOUSEHOLD", F.concat(F.lit('{"response":{"result":'), keyed, one, F.lit("}}}")))
        .otherwise(F.concat(F.lit('{"result":'), keyed, listed, F.lit("}}"))).alias("raw_json"))


@query("json_polymorphic_payload", """
    SELECT CAST(c_custkey AS VARCHAR) AS employee_id, c_name AS first_name, c_mktsegment AS department FROM customer
""")
def json_polymorphic_payload(t):
    payload = P.locate(F.col("raw_json"), P.EMPLOYEE_PATHS, or_whole_line=True)
    texts = polymorphic_lines(t.customer).select(F.explode(P.record_texts(payload, "EmployeeID")).alias("x"))
    records = texts.select(F.from_json("x", P.struct_ddl(("EmployeeID", "FirstName", "Department"))).alias("r"))
    return records.select(F.col("r.EmployeeID").alias("employee_id"), F.col("r.FirstName").alias("first_name"),
                          F.col("r.Department").alias("department"))


@query("json_first_map_value", """
    SELECT o_orderkey AS order_id, o_orderpriority AS session, o_totalprice AS amount FROM orders
""")
def json_first_map_value(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    days = F.create_map(
        F.concat(day, F.lit(" first")), F.struct(F.col("o_orderpriority").alias("Session"), money("o_totalprice").alias("Amount")),
        F.concat(day, F.lit(" second")), F.struct(F.col("o_orderstatus").alias("Session"), F.lit("0").alias("Amount")))
    lines = t.spread("orders").select("o_orderkey", F.to_json(F.struct(days.alias("Days"))).alias("record_json"))
    decoded = lines.select("o_orderkey", F.from_json(
        "record_json", "STRUCT<Days: MAP<STRING, STRUCT<Session: STRING, Amount: STRING>>>").alias("r"))
    first = decoded.select("o_orderkey", P.first_map_value(F.col("r.Days")).alias("d"))
    return first.select(F.col("o_orderkey").alias("order_id"), F.col("d.Session").alias("session"),
                        to_decimal(F.col("d.Amount"), 12, 2).cast("double").alias("amount"))


@query("events_props_locate", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
""")
def events_props_locate(t):
    found = P.locate(F.col("props"), ("$.missing.k", "$.k"))
    return t.events.select("event_id", to_int(found).alias("k"))


@query("nested_flatten", """
    SELECT c_custkey AS "key", c_name AS "person.name", n_name AS "person.nation.name", r_name AS "person.nation.region",
           '["' || c_mktsegment || '","' || n_name || '"]' AS "person.tags", FALSE AS last_dq_checked
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def nested_flatten(t):
    from ..operators.runs import catalog_rows
    joined = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")) \
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    nested = joined.select(
        F.col("c_custkey").alias("key"),
        F.struct(F.col("c_name").alias("name"),
                 F.struct(F.col("n_name").alias("name"), F.col("r_name").alias("region")).alias("nation"),
                 F.array("c_mktsegment", "n_name").alias("tags"), F.lit(1).alias("unused")).alias("person"))
    return catalog_rows(nested, ("key", "person.name", "person.nation.name", "person.nation.region", "person.tags",
                                 "absent", "last_dq_checked"))


@query("job_settings_flatten", """
    SELECT CAST(p_partkey AS VARCHAR) AS job_id, p_name AS name, p_brand AS creator, CAST(p_size AS VARCHAR) AS cluster_size,
           p_type AS description, '["' || p_brand || '@x.org"]' AS email_notifications_on_failure, 'UTC' AS schedule_timezone,
           CAST(NULL AS VARCHAR) AS state
    FROM part
""")
def job_settings_flatten(t):
    autoscale = nest(F.col("p_size"), "new_cluster", "autoscale", "max_workers")
    settings = F.struct(
        F.col("p_name").alias("name"), F.col("p_type").alias("description"),
        F.struct(F.array(F.concat("p_brand", F.lit("@x.org"))).alias("on_failure")).alias("email_notifications"),
        F.struct(F.lit("UTC").alias("timezone_id")).alias("schedule"), F.array(autoscale).alias("job_clusters"))
    docs = t.part.select(F.to_json(F.struct(F.col("p_partkey").alias("job_id"), F.col("p_brand").alias("creator_user_name"),
                                            settings.alias("settings"))).alias("job_json"))
    return flatten_job_settings(docs).select("job_id", "name", "creator", "cluster_size", "description",
                                             "email_notifications_on_failure", "schedule_timezone", "state")


@query("notification_ids", """
    SELECT event_id, CASE WHEN event_type <> 'view' THEN CAST(event_id AS VARCHAR) END AS run_id,
           CASE WHEN event_type <> 'click' THEN CAST(user_id AS VARCHAR) END AS job_id
    FROM events
""")
def notification_ids_query(t):
    kind = F.col("event_type")
    run = F.when(kind != "view", F.struct(F.col("event_id").alias("run_id")))
    job = F.when(kind != "click", F.struct(F.col("user_id").alias("job_id")))
    bodies = t.events.select("event_id", F.to_json(F.struct(run.alias("run"), job.alias("job"))).alias("body"))
    return notification_ids(bodies, "body", "event_id")


@query("run_json_flatten", """
    WITH e AS (SELECT *, epoch_us(ts) // 1000 AS start_ms, epoch_us(ts) // 1000 + CAST(floor(value * 1000) AS BIGINT) AS end_ms FROM events)
    SELECT 't' || event_id AS task_run_id, CAST(event_id AS VARCHAR) AS run_id, user_id AS job_id, event_type AS task_name,
           strftime(to_timestamp(start_ms / 1000.0) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS start_time,
           strftime(to_timestamp(end_ms / 1000.0) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS end_time,
           end_ms - start_ms AS execution_duration,
           CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
           CASE WHEN event_type = 'error' THEN 'failed with ' || props ELSE 'No error' END AS error_message,
           'TERMINATED' AS life_cycle_state, 'c' || user_id AS cluster_id,
           CASE WHEN event_type = 'click' THEN 'Unknown Trigger' ELSE 'PERIODIC' END AS trigger, 'N/A' AS notebook_path
    FROM e
    UNION ALL
    SELECT 'u' || event_id, CAST(event_id AS VARCHAR), user_id, 'N/A', '1970-01-01 00:00:00', '1970-01-01 00:00:00', 0,
           'N/A', 'No error', 'N/A', 'N/A', CASE WHEN event_type = 'click' THEN 'Unknown Trigger' ELSE 'PERIODIC' END, '/jobs/clean'
    FROM e
""")
def run_json_flatten(t):
    none = F.lit(None)
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    failed = F.col("event_type") == "error"
    full = F.struct(
        F.concat(F.lit("t"), text("event_id")).alias("run_id"), F.col("event_type").alias("task_key"), start.alias("start_time"),
        (start + F.floor(F.col("value") * 1000)).alias("end_time"),
        F.struct(F.when(failed, "FAILED").otherwise("SUCCESS").alias("result_state"),
                 F.lit("TERMINATED").alias("life_cycle_state")).alias("state"),
        F.struct(F.concat(F.lit("c"), text("user_id")).alias("cluster_id")).alias("cluster_instance"),
        none.cast("struct<notebook_path:string>").alias("notebook_task"))
    bare = F.struct(
        F.concat(F.lit("u"), text("event_id")).alias("run_id"), none.cast("string").alias("task_key"),
        none.cast("bigint").alias("start_time"), none.cast("bigint").alias("end_time"),
        none.cast("struct<result_state:string,life_cycle_state:string>").alias("state"),
        none.cast("struct<cluster_id:string>").alias("cluster_instance"),
        F.struct(F.lit("/jobs/clean").alias("notebook_path")).alias("notebook_task"))
    trigger = F.when(F.col("event_type") != "click", "PERIODIC")
    events = t.spread("events")
    runs = events.select(text("event_id").alias("run_id"), F.col("user_id").alias("job_id"),
                           F.to_json(F.struct(F.array(full, bare).alias("tasks"), trigger.alias("trigger"))).alias("run_json"))
    outputs = events.select(F.concat(F.lit("t"), text("event_id")).alias("task_run_id"), F.to_json(F.struct(
        F.when(failed, F.concat(F.lit("failed with "), "props")).alias("error"))).alias("output_json"))
    return flatten_runs(runs, outputs).select(
        "task_run_id", "run_id", "job_id", "task_name", "start_time", "end_time", "execution_duration", "status",
        "error_message", "life_cycle_state", "cluster_id", "trigger", "notebook_path")
