"""Job-run analytics queries.  Events stand for task runs: the user is the job, errors are failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics
from .cleaning import stamp
from .nested import text
from .registry import query

TASK_RUNS_SQL = """
    task_runs AS (
        SELECT CAST(event_id AS VARCHAR) AS task_run_id, user_id || '-' || strftime(ts, '%Y%m%d') AS run_id, user_id AS job_id,
               event_type AS task_name, ts AS start_time,
               ts + to_milliseconds(CAST(floor(value * 1000) AS BIGINT)) AS end_time,
               CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'CANCELED' ELSE 'SUCCESS' END AS status,
               CASE WHEN event_type = 'error' THEN 'failed with ' || props WHEN event_type = 'view' THEN 'No error' END AS error_message,
               '/jobs/' || event_type AS notebook_path, 'http://runs.example/' || user_id AS run_page_url
        FROM events)
"""


def task_runs(t):
    kind = F.col("event_type")
    start = F.col("ts").cast("timestamp")
    status = F.when(kind == "error", "FAILED").when(kind == "signup", "CANCELED").otherwise("SUCCESS")
    end = F.timestamp_micros(F.unix_micros(start) + F.floor(F.col("value") * 1000) * 1000)
    message = F.when(kind == "error", F.concat(F.lit("failed with "), "props")).when(kind == "view", F.lit("No error"))
    given = {
        "task_run_id": text("event_id"), "run_id": F.concat(text("user_id"), F.lit("-"), F.date_format("ts", "yyyyMMdd")),
        "job_id": F.col("user_id"), "task_name": kind, "start_time": start, "end_time": end, "status": status,
        "execution_duration": F.floor(F.col("value") * 1000), "error_message": message,
        "notebook_path": F.concat(F.lit("/jobs/"), kind), "run_page_url": F.concat(F.lit("http://runs.example/"), text("user_id"))}
    return t.events.select(*[given.get(c, F.lit("N/A")).alias(c) for c in analytics.TASK_RUN_COLUMNS])


def jobs(t):
    return t.customer.select(F.col("c_custkey").alias("job_id"), F.col("c_name").alias("name"))


def diagnoses(t):
    """A diagnosis for every error event."""
    errors = t.events.filter(F.col("event_type") == "error")
    return errors.select(
        text("event_id").alias("task_run_id"), F.when(F.col("value") > 100, "CLUSTER_ERROR").otherwise("TYPE_ERROR").alias("error_type"),
        F.lit("High").alias("confidence"), F.col("props").alias("reason"), F.lit("Summary: x").alias("diagnosis"),
        F.lit("Medium").alias("severity_score"))


def times(df):
    return df.withColumns({c: stamp(c) for c in ("start_time", "end_time") if c in df.columns})


@query("task_run_stats", f"""
    WITH {TASK_RUNS_SQL}
    SELECT count(*) AS total_runs, count(*) FILTER (status = 'SUCCESS') AS success_count,
           round_even(CAST(count(*) FILTER (status = 'SUCCESS') AS DOUBLE) / count(*) * 100, 2) AS success_percent,
           count(*) FILTER (status = 'FAILED') AS failed_count,
           round_even(CAST(count(*) FILTER (status = 'FAILED') AS DOUBLE) / count(*) * 100, 2) AS failed_percent
    FROM task_runs
""")
def task_run_stats(t):
    return analytics.task_run_stats(task_runs(t))


@query("job_status", f"""
    WITH {TASK_RUNS_SQL}
    SELECT job_id, status, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
           strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, error_message,
           count(error_message) OVER (PARTITION BY job_id) AS error_count
    FROM task_runs QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY start_time DESC, task_run_id DESC) = 1
""")
def job_status(t):
    return times(analytics.job_status(task_runs(t)))


@query("top_errors", f"""
    WITH {TASK_RUNS_SQL}, latest AS (
        SELECT error_message, count(*) OVER (PARTITION BY error_message) AS error_count, job_id,
               strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time
        FROM task_runs WHERE error_message IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY error_message ORDER BY task_runs.end_time DESC, task_run_id DESC) = 1)
    SELECT * FROM latest ORDER BY error_count DESC, error_message LIMIT 10
""")
def top_errors(t):
    return times(analytics.top_errors(task_runs(t)))


@query("job_runs", f"""
    WITH {TASK_RUNS_SQL}
    SELECT run_id, CASE WHEN bool_or(status = 'FAILED') THEN 'FAILED' ELSE 'SUCCESS' END AS status, max(c_name) AS job_name,
           max(run_page_url) AS run_page_url, strftime(min(start_time), '%Y-%m-%d %H:%M:%S') AS start_time,
           strftime(max(end_time), '%Y-%m-%d %H:%M:%S') AS end_time
    FROM task_runs JOIN customer ON c_custkey = job_id GROUP BY run_id
""")
def job_runs(t):
    return times(analytics.job_runs(task_runs(t), jobs(t)))


@query("run_tasks", f"""
    WITH {TASK_RUNS_SQL}
    SELECT task_run_id, c_name AS job_name, run_id, task_name, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
           strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, status, notebook_path
    FROM task_runs JOIN customer ON c_custkey = job_id WHERE run_id = '8-20240101'
""")
def run_tasks(t):
    """The tasks of one run: the lookup is the feature."""
    return times(analytics.run_tasks(task_runs(t), jobs(t), "8-20240101"))


@query("task_detail", f"""
    WITH {TASK_RUNS_SQL}
    SELECT c_name AS job_name, task_run_id, run_id, status, error_message, 'Medium' AS severity_score, props AS reason
    FROM task_runs JOIN customer ON c_custkey = job_id JOIN events ON CAST(event_id AS VARCHAR) = task_run_id
    WHERE task_run_id = '0' AND run_id = '8-20240101'
""")
def task_detail(t):
    """One task run in full: the lookup is the feature."""
    detail = analytics.task_detail(task_runs(t), jobs(t), diagnoses(t), "8-20240101", "0")
    return detail.select("job_name", "task_run.task_run_id", "task_run.run_id", "task_run.status", "task_run.error_message",
                         "diagnosis.severity_score", "diagnosis.reason")


@query("failed_alerts", f"""
    WITH {TASK_RUNS_SQL}
    SELECT task_run_id, run_id, job_id, status, run_page_url,
           CASE WHEN value > 100 THEN 'CLUSTER_ERROR' ELSE 'TYPE_ERROR' END AS error_type, 'Medium' AS severity_score,
           'High' AS confidence, props AS reason, c_name AS job_name
    FROM task_runs JOIN customer ON c_custkey = job_id JOIN events ON CAST(event_id AS VARCHAR) = task_run_id
    WHERE status = 'FAILED'
""")
def failed_alerts(t):
    return analytics.failed_alerts(task_runs(t), diagnoses(t), jobs(t))


@query("jobs_by_last_run", """
    SELECT c_custkey AS job_id, c_name AS name, coalesce(max(epoch_us(ts) // 1000), 0) AS last_start,
           coalesce(strftime(max(ts), '%Y-%m-%d %H:%M:%S'), 'Never Run') AS last_run
    FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey, c_name
""")
def jobs_by_last_run(t):
    runs = t.events.select(F.col("user_id").alias("job_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("start_time"))
    return analytics.jobs_by_last_run(jobs(t), runs)
