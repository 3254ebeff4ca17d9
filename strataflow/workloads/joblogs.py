"""Error-log, diagnosis and report queries.  Each user's events are the lines of one log, in event order."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diagnose
from ..operators.blocks import integer_block
from ..operators.layout import stage
from ..operators.logs import GROUP_KEYS, error_labels, group_errors, number_error_groups, parse_error_log
from ..plans.error_report import diagnosed_groups
from .cleaning import stamp
from .jobruns import TASK_RUNS_SQL, diagnoses, task_runs
from .nested import text
from .registry import query


def log_lines(t):
    """Job headers (signup), run headers (view), task errors (error), plain errors (click) and noise (purchase)."""
    kind, user, event = F.col("event_type"), text("user_id"), text("event_id")
    head = F.concat(F.lit("["), stamp("ts"), F.lit(",000] "))
    k = F.get_json_object("props", "$.k")
    line = F.when(kind == "signup", F.concat(head, F.lit("0 - INFO - app - Logging for job: J (ID: "), user, F.lit(")"))) \
        .when(kind == "view", F.concat(head, F.lit("0 - INFO - app - Run 1: ID="), event,
                                       F.lit(" | Life Cycle=TERMINATED | Result=FAILED | Start="), stamp("ts"))) \
        .when(kind == "error", F.concat(F.lit("  "), head, F.lit("100 - ERROR - src.py - [100 Error 1] Task [load-"), k, F.lit("] run_id="), event,
                                        F.lit(" ERROR: boom "), k)) \
        .when(kind == "click", F.concat(head, F.lit("101 - ERROR - step-"), k, F.lit(" - plain failure"))) \
        .otherwise(F.concat(head, F.lit("0 - INFO - app - fine")))
    # The generator makes the derived text a plain column, as it would be when read from a file; otherwise every mention
    # of the line in a pushed-down filter would build it again.
    return t.spread("events").select(F.concat(F.lit("log"), user).alias("source"), F.col("event_id").alias("line_no"),
                                     F.explode(F.array(line)).alias("line"))


PARSED_SQL = """
    k AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events),
    carried AS (
        SELECT *, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER w AS run_event,
               last_value(CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END IGNORE NULLS) OVER w AS run_start,
               max(CASE WHEN event_type = 'signup' THEN user_id END) OVER (PARTITION BY user_id) AS job
        FROM k WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
    parsed AS (
        SELECT 'log' || user_id AS source, event_id AS line_no,
               CASE WHEN run_start IS NULL THEN '' WHEN event_type = 'error' THEN event_id || '_' || run_start
                    ELSE run_event || '_' || run_start END AS runs,
               coalesce(CAST(job AS VARCHAR), 'UNKNOWN') AS job_id,
               CASE event_type WHEN 'error' THEN 'load-' || k ELSE 'step-' || k END AS task_name,
               CASE event_type WHEN 'error' THEN 'boom ' || k ELSE 'plain failure' END AS message
        FROM carried WHERE event_type IN ('error', 'click'))
"""


def parsed_log(t):
    # Small blocks, so that carrying a header over block borders is exercised even on small tables.
    return parse_error_log(log_lines(t), block=integer_block(F.col("line_no"), 1 << 10))


@query("parse_error_log", f"WITH {PARSED_SQL} SELECT * FROM parsed")
def parse_error_log_query(t):
    return parsed_log(t)


@query("group_errors", f"""
    WITH {PARSED_SQL}
    SELECT DISTINCT job_id, task_name, message, runs,
           len(list(DISTINCT runs) OVER (PARTITION BY job_id, task_name, message))::BIGINT AS n_runs FROM parsed
""")
def group_errors_query(t):
    """Every group with the number of its run labels, beside each label."""
    labels = error_labels(parsed_log(t))
    return labels.join(group_errors(labels), GROUP_KEYS).select(*GROUP_KEYS, "runs", "n_runs")


@query("group_errors_in_parts", f"""
    WITH {PARSED_SQL}, g AS (SELECT DISTINCT message, runs FROM parsed)
    SELECT message, count(*) AS labels, CAST(sum(length(runs)) AS BIGINT) AS characters FROM g GROUP BY message
""")
def group_errors_in_parts(t):
    """Large groups: every label of a message over all jobs and tasks counts exactly once."""
    parsed = parsed_log(t).withColumns({"job_id": F.lit("all"), "task_name": F.lit("all")})
    return error_labels(parsed).groupBy("message").agg(F.count(F.lit(1)).alias("labels"), F.sum(F.length("runs")).alias("characters"))


ONE_GROUP_SQL = f"""
    WITH {PARSED_SQL}, g AS (SELECT DISTINCT runs FROM parsed), n AS (SELECT count(*) AS n FROM g)
    SELECT 0 AS section, CAST(0 AS BIGINT) AS seq, 0 AS line, 'Job ID: all' || chr(10) || chr(10) || 'Error Summary:' AS text FROM n WHERE n > 0
    UNION ALL SELECT 1, 1, 0, '- OTHER_ERROR: 1' FROM n WHERE n > 0
    UNION ALL SELECT 2, 1, 0, 'Error Group 1 [OTHER_ERROR - Medium]' || chr(10) || 'Task: all' FROM n WHERE n > 0
    UNION ALL SELECT 2, 1, 1, 'Run: ' || runs FROM g
    UNION ALL SELECT 2, 1, 2, 'Message: all' || chr(10) || 'Diagnosis: No diagnosis available.' FROM n WHERE n > 0
"""


@query("error_report_one_group", ONE_GROUP_SQL)
def error_report_one_group(t):
    """One group that holds all labels: one head, every label once."""
    everything = {k: F.lit("all") for k in GROUP_KEYS}
    labels = stage(error_labels(parsed_log(t).withColumns(everything)), "error-labels")
    answers = {c: F.lit(None).cast("string") for c in ("error_type", "severity_score", "diagnosis")}
    return diagnose.error_report(group_errors(labels).withColumns(answers), labels).select("section", "seq", "line", "text")


NUMBERED_SQL = """
    k AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events WHERE event_type <> 'view'),
    e AS (SELECT user_id AS job_id, event_id AS ord, CASE WHEN event_type = 'error' THEN 'load-' || k ELSE event_type END AS source FROM k),
    f AS (SELECT job_id, source, min(ord) AS first_ord FROM e GROUP BY job_id, source),
    g AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY first_ord) + 99 AS group_no FROM f)
"""


@query("number_error_groups", f"""
    WITH {NUMBERED_SQL}
    SELECT job_id, ord, source, group_no, row_number() OVER (PARTITION BY job_id, source ORDER BY ord) AS error_index
    FROM e JOIN g USING (job_id, source)
""")
def number_error_groups_query(t):
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k")
    error = F.when(kind == "error", F.concat(F.lit("Job aborted\r\nTask load-"), k, F.lit(" failed"))) \
        .when(kind != "view", F.concat(F.lit("bad input "), k))
    errors = t.spread("events").select(F.col("user_id").alias("job_id"), F.col("event_id").alias("ord"), kind.alias("task_key"),
                             error.alias("error_text"))
    numbered = number_error_groups(errors, block_rows=1 << 10)
    return numbered.select("job_id", "ord", "source", "group_no", "error_index")


def classification_text(kind_column, value, props):
    """Answers with all labels, with a repeated label, and with none that can be read."""
    return F.when(kind_column == "error", F.concat(F.lit("ERROR_TYPE: TYPE_ERROR\nCONFIDENCE: High\nREASON: props: "), props)) \
        .when(kind_column == "click", F.lit("\nERROR_TYPE: NETWORK_ERROR\nERROR_TYPE:  CLUSTER_ERROR \nCONFIDENCE: Medium\n")) \
        .otherwise(F.lit("no idea"))


LABELS_SQL = """
    CASE event_type WHEN 'error' THEN 'TYPE_ERROR' WHEN 'click' THEN 'CLUSTER_ERROR' ELSE 'OTHER_ERROR' END AS error_type,
    CASE event_type WHEN 'error' THEN 'High' WHEN 'click' THEN 'Medium' ELSE 'Low' END AS confidence,
    CASE WHEN event_type = 'error' THEN 'props: ' || props ELSE 'Could not parse' END AS reason
"""


def classifications(t):
    return t.events.select(text("event_id").alias("task_run_id"),
                           classification_text(F.col("event_type"), F.col("value"), F.col("props")).alias("response"))


@query("labelled_text_parse", f"SELECT CAST(event_id AS VARCHAR) AS task_run_id, {LABELS_SQL} FROM events")
def labelled_text_parse(t):
    return diagnose.parse_labels(classifications(t), "response", diagnose.CLASSIFICATION_LABELS, "task_run_id")


@query("merge_diagnosis", f"""
    SELECT CAST(event_id AS VARCHAR) AS task_run_id, {LABELS_SQL},
           CASE WHEN event_type <> 'signup' THEN concat('Summary: bad ', props, chr(10), 'Root Cause: ', chr(10), 'Next Steps: retry',
               chr(10), 'Action Owner: ') END AS diagnosis,
           CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN 'High' ELSE 'Medium' END AS severity_score,
           CASE WHEN event_type <> 'signup' THEN user_id END AS job_id,
           CASE WHEN event_type <> 'signup' THEN user_id || '-' || strftime(ts, '%Y%m%d') END AS job_run_id
    FROM events
""")
def merge_diagnosis(t):
    answers = t.events.filter(F.col("event_type") != "signup").select(text("event_id").alias("task_run_id"), F.concat(
        F.lit("SUMMARY: bad "), "props", F.lit("\nNEXT_STEPS: retry"),
        F.when(F.col("event_type") == "error", F.lit("\nSEVERITY: High")).otherwise(F.lit(""))).alias("response"))
    return diagnose.merge_diagnosis(task_runs(t), classifications(t), answers)


@query("error_type_counts", f"""
    SELECT error_type, count(*) AS n FROM (SELECT {LABELS_SQL} FROM events) GROUP BY error_type
""")
def error_type_counts(t):
    parsed = diagnose.parse_labels(classifications(t), "response", diagnose.CLASSIFICATION_LABELS)
    unknown = F.when(F.col("error_type") != "OTHER_ERROR", F.col("error_type"))
    return diagnose.error_type_counts(parsed.withColumn("error_type", unknown))


@query("route_remediation", """
    WITH n AS (SELECT user_id AS job_id, bool_or(event_type = 'error' AND value > 100) AS q, bool_or(event_type = 'click' AND value > 100) AS c
               FROM events GROUP BY user_id)
    SELECT job_id, q AS needs_data_quality, c AS needs_cluster_restart,
           CASE WHEN q AND c THEN 'data_quality,cluster_restart' WHEN q THEN 'data_quality' WHEN c THEN 'cluster_restart' ELSE 'none' END AS route
    FROM n
""")
def route_remediation(t):
    kind = F.when(F.col("value") <= 100, "OTHER_ERROR").when(F.col("event_type") == "error", "VALUE_ERROR") \
        .when(F.col("event_type") == "click", "CLUSTER_ERROR")
    return diagnose.route_remediation(t.events.select(F.col("user_id").alias("job_id"), kind.alias("error_type")))


@query("task_report_blocks", f"""
    WITH {TASK_RUNS_SQL}
    SELECT job_id, task_run_id, 'Task: ' || task_name || ' (' || task_run_id || ')' || chr(10) || 'Error: ' || coalesce(error_message, 'null')
           || chr(10) || 'Type: ' || CASE WHEN status <> 'FAILED' THEN 'null (null)' WHEN value > 100 THEN 'CLUSTER_ERROR (Medium)'
           ELSE 'TYPE_ERROR (Medium)' END || chr(10) || 'Diagnosis: ' || CASE WHEN status = 'FAILED' THEN 'Summary: x' ELSE 'null' END
           || chr(10) || repeat('-', 40) AS block_text
    FROM task_runs JOIN events ON CAST(event_id AS VARCHAR) = task_run_id
""")
def task_report_blocks(t):
    return diagnose.task_report_blocks(task_runs(t), diagnoses(t))


@query("error_report", f"""
    WITH {PARSED_SQL},
    groups AS (
        SELECT job_id, task_name, message,
               CASE WHEN message = 'plain failure' THEN 'CLUSTER_ERROR' ELSE 'OTHER_ERROR' END AS error_type,
               CASE WHEN message = 'plain failure' THEN 'High' ELSE 'Medium' END AS severity,
               CASE WHEN message = 'plain failure' THEN concat('Summary: s', chr(10), 'Root Cause: ', chr(10), 'Next Steps: ', chr(10),
                   'Action Owner: ') ELSE 'No diagnosis available.' END AS diagnosis
        FROM parsed GROUP BY job_id, task_name, message),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY task_name, message) AS seq FROM groups)
    SELECT DISTINCT job_id, 0 AS section, CAST(0 AS BIGINT) AS seq, 0 AS line, 'Job ID: ' || job_id || chr(10) || chr(10) || 'Error Summary:' AS text FROM groups
    UNION ALL
    SELECT job_id, 1, row_number() OVER (PARTITION BY job_id ORDER BY error_type), 0, '- ' || error_type || ': ' || n
    FROM (SELECT job_id, error_type, count(*) AS n FROM groups GROUP BY job_id, error_type)
    UNION ALL
    SELECT job_id, 2, seq, 0, concat('Error Group ', seq, ' [', error_type, ' - ', severity, ']', chr(10), 'Task: ', task_name) FROM numbered
    UNION ALL
    SELECT job_id, 2, seq, 2, concat('Message: ', message, chr(10), 'Diagnosis: ', diagnosis) FROM numbered
    UNION ALL
    SELECT DISTINCT job_id, 2, seq, 1, 'Run: ' || runs FROM numbered JOIN parsed USING (job_id, task_name, message)
""")
def error_report(t):
    """Log to report; answers exist for the plain failures only."""
    labels = stage(error_labels(parsed_log(t)), "error-labels")
    answered = t.events.filter(F.col("event_type") == "click").select(
        F.concat(F.lit("step-"), F.get_json_object("props", "$.k")).alias("task_name"), F.lit("plain failure").alias("message")).distinct()
    kinds = answered.withColumn("response", F.lit("ERROR_TYPE: CLUSTER_ERROR\nCONFIDENCE: High"))
    details = answered.withColumn("response", F.lit("SUMMARY: s\nSEVERITY: High"))
    return diagnose.error_report(diagnosed_groups(group_errors(labels), kinds, details), labels)
