"""Job-run analytics over ``task_runs``, ``job`` and ``diagnosis`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .latest import latest_with_count
from .metrics import percent

# Fixed values.
FAILED, SUCCESS = "FAILED", "SUCCESS"
NO_ERROR_TEXT = "No error"
TASK_RUN_COLUMNS = (
    "task_run_id", "run_id", "job_id", "task_name", "start_time", "end_time", "execution_duration", "status",
    "error_message", "life_cycle_state", "result_state", "user_cancelled_or_timeout", "cluster_id", "trigger",
    "notebook_path", "run_type", "run_page_url")
DIAGNOSIS_COLUMNS = ("task_run_id", "error_type", "confidence", "reason", "diagnosis", "severity_score")


def task_run_stats(task_runs: DataFrame) -> DataFrame:
    """Total, successful and failed task runs with percentages."""
    counts = task_runs.agg(F.count("task_run_id").alias("total_runs"),
                           F.count_if(F.col("status") == SUCCESS).alias("success_count"),
                           F.count_if(F.col("status") == FAILED).alias("failed_count"))
    total = F.col("total_runs")
    return counts.select("total_runs", "success_count", percent(F.col("success_count"), total).alias("success_percent"),
                         "failed_count", percent(F.col("failed_count"), total).alias("failed_percent"))


def job_status(task_runs: DataFrame) -> DataFrame:
    """Latest task run of each job with the job's error count."""
    return latest_with_count(task_runs, ["job_id"], ["start_time", "task_run_id"],
                             ["status", "start_time", "end_time", "error_message"],
                             F.col("error_message"), "error_count")


def top_errors(task_runs: DataFrame, n: int = 10, exclude_placeholder: bool = False) -> DataFrame:
    """The ``n`` most frequent error messages with the job and time of the latest one."""
    errors = task_runs.filter(F.col("error_message").isNotNull())
    if exclude_placeholder:
        errors = errors.filter(F.col("error_message") != NO_ERROR_TEXT)
    latest = latest_with_count(errors, ["error_message"], ["end_time", "task_run_id"], ["job_id", "end_time"],
                               F.lit(1), "error_count")
    ranked = latest.select("error_message", "error_count", "job_id", "end_time")
    return ranked.orderBy(F.desc("error_count"), "error_message").limit(n)


def _failed_first(status):
    return F.when(F.max(F.when(status == FAILED, 1).otherwise(0)) == 1, FAILED).otherwise(SUCCESS)


def job_runs(task_runs: DataFrame, job: DataFrame) -> DataFrame:
    """One row per run: failed if any task failed, first start, last end; latest runs first.

    Task runs are reduced to one row per (run, job) before the job names are joined in.
    """
    status = F.col("status")
    per_job = task_runs.groupBy("run_id", "job_id").agg(
        _failed_first(status).alias("status"), F.max("run_page_url").alias("run_page_url"),
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"))
    named = per_job.join(job.select("job_id", F.col("name").alias("job_name")), "job_id")
    rolled = named.groupBy("run_id").agg(
        _failed_first(status).alias("status"), F.max("job_name").alias("job_name"),
        F.max("run_page_url").alias("run_page_url"), F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"))
    return rolled.orderBy(F.col("end_time").desc_nulls_first(), "run_id")


def run_tasks(task_runs: DataFrame, job: DataFrame, run_id) -> DataFrame:
    """Tasks of one run in start order."""
    tasks = task_runs.filter(F.col("run_id") == F.lit(run_id))
    named = tasks.join(job.select("job_id", F.col("name").alias("job_name")), "job_id")
    return named.select("task_run_id", "job_name", "run_id", "task_name", "start_time", "end_time", "status",
                        "notebook_path").orderBy(F.col("start_time").asc_nulls_last(), "task_run_id")


def task_detail(task_runs: DataFrame, job: DataFrame, diagnosis: DataFrame, run_id, task_run_id) -> DataFrame:
    """One task run with its job name and, if there is one, its diagnosis; empty if unknown."""
    task = task_runs.filter((F.col("run_id") == F.lit(run_id)) & (F.col("task_run_id") == F.lit(task_run_id)))
    names = job.select(F.col("job_id").alias("_job_id"), F.col("name").alias("job_name"))
    found = diagnosis.select(F.col("task_run_id").alias("_diag_id"),
                             F.struct(*DIAGNOSIS_COLUMNS).alias("diagnosis")) \
        .filter(F.col("_diag_id") == F.lit(task_run_id))
    return (task.select(F.struct(*TASK_RUN_COLUMNS).alias("task_run"))
            .join(names, F.col("task_run.job_id") == F.col("_job_id"))
            .join(found, F.col("task_run.task_run_id") == F.col("_diag_id"), "left")
            .select("job_name", "task_run", "diagnosis").limit(1))


def failed_alerts(task_runs: DataFrame, diagnosis: DataFrame, job: DataFrame) -> DataFrame:
    """Diagnosed failed task runs, latest first."""
    failed = task_runs.filter(F.col("status") == FAILED) \
        .select("task_run_id", "run_id", "job_id", "status", "run_page_url", "start_time")
    found = diagnosis.select("task_run_id", "error_type", "severity_score", "confidence", "reason")
    named = job.select("job_id", F.col("name").alias("job_name"))
    alerts = failed.join(found, "task_run_id").join(named, "job_id")
    return alerts.orderBy(F.col("start_time").desc_nulls_first(), "task_run_id").select(
        "task_run_id", "run_id", "job_id", "status", "run_page_url", "error_type", "severity_score", "confidence",
        "reason", "job_name")


def jobs_by_last_run(job: DataFrame, runs: DataFrame) -> DataFrame:
    """Jobs by their last start in epoch milliseconds, oldest first; jobs never run carry 0."""
    last = runs.groupBy("job_id").agg(F.max("start_time").alias("last_start"))
    joined = job.join(last, "job_id", "left").withColumn("last_start", F.coalesce("last_start", F.lit(0)))
    text = F.when(F.col("last_start") == 0, "Never Run").otherwise(
        F.date_format(F.timestamp_millis("last_start"), "yyyy-MM-dd HH:mm:ss"))
    return joined.withColumn("last_run", text).orderBy("last_start", "job_id")
