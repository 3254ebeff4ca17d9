"""Flattening of run documents, job settings and catalog metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.temporal import duration_millis, millis_to_text
from .analytics import NO_ERROR_TEXT, TASK_RUN_COLUMNS

# Defaults of missing fields and the parts of the documents that are read.
MISSING = "N/A"
UNKNOWN_TRIGGER = "Unknown Trigger"
RUN_DOCUMENT = """STRUCT<tasks: ARRAY<STRUCT<run_id: STRING, task_key: STRING, start_time: BIGINT, end_time: BIGINT,
    state: STRUCT<result_state: STRING, life_cycle_state: STRING, user_cancelled_or_timedout: STRING>,
    cluster_instance: STRUCT<cluster_id: STRING>, notebook_task: STRUCT<notebook_path: STRING>>>,
    trigger: STRING, run_type: STRING, run_page_url: STRING>"""
JOB_SETTING_PATHS = {
    "job_id": "$.job_id",
    "name": "$.settings.name",
    "creator": "$.creator_user_name",
    "created_time": "$.created_time",
    "description": "$.settings.description",
    "email_notifications_on_failure": "$.settings.email_notifications.on_failure",
    "schedule_timezone": "$.settings.schedule.timezone_id",
    "state": "$.state.life_cycle_state",
    "cluster_size": "$.settings.job_clusters[0].new_cluster.autoscale.max_workers",
    "webhook_notifications_on_failure": "$.settings.webhook_notifications.on_failure",
    "webhook_notifications_on_success": "$.settings.webhook_notifications.on_success",
    "webhook_notifications_on_start": "$.settings.webhook_notifications.on_start",
    "webhook_notifications_on_duration_warning_threshold_exceeded":
        "$.settings.webhook_notifications.on_duration_warning_threshold_exceeded",
    "webhook_notifications_on_streaming_backlog_exceeded":
        "$.settings.webhook_notifications.on_streaming_backlog_exceeded",
}


def notification_ids(notifications: DataFrame, body: str = "body", *keep) -> DataFrame:
    """``run_id`` and ``job_id`` of job notifications, null where absent."""
    return notifications.select(*keep, F.get_json_object(body, "$.run.run_id").alias("run_id"),
                                F.get_json_object(body, "$.job.job_id").alias("job_id"))


def flatten_runs(runs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Task runs from run documents ``(run_id, job_id, run_json)`` and outputs ``(task_run_id, output_json)``."""
    docs = runs.select("run_id", "job_id", F.from_json("run_json", RUN_DOCUMENT).alias("doc"))
    tasks = docs.select("run_id", "job_id", F.explode("doc.tasks").alias("task"), F.col("doc.trigger").alias("trigger"),
                        F.col("doc.run_type").alias("run_type"), F.col("doc.run_page_url").alias("run_page_url"))

    def field(path: str, default: str = MISSING) -> Column:
        return F.coalesce(F.col(path), F.lit(default))

    zero = F.lit(0).cast("bigint")
    start, end = F.coalesce("task.start_time", zero), F.coalesce("task.end_time", zero)
    flat = tasks.select(
        field("task.run_id").alias("task_run_id"), "run_id", "job_id", field("task.task_key").alias("task_name"),
        millis_to_text(start).alias("start_time"), millis_to_text(end).alias("end_time"),
        duration_millis(F.col("task.start_time"), F.col("task.end_time")).alias("execution_duration"),
        field("task.state.result_state").alias("status"), field("task.state.life_cycle_state").alias("life_cycle_state"),
        field("task.state.result_state").alias("result_state"),
        field("task.state.user_cancelled_or_timedout").alias("user_cancelled_or_timeout"),
        field("task.cluster_instance.cluster_id").alias("cluster_id"), field("trigger", UNKNOWN_TRIGGER).alias("trigger"),
        field("task.notebook_task.notebook_path").alias("notebook_path"), field("run_type").alias("run_type"),
        field("run_page_url").alias("run_page_url"))
    errors = outputs.select("task_run_id", F.get_json_object("output_json", "$.error").alias("_error"))
    joined = flat.join(errors, "task_run_id", "left")
    return joined.withColumn("error_message", F.coalesce("_error", F.lit(NO_ERROR_TEXT))).select(*TASK_RUN_COLUMNS)


def flatten_job_settings(jobs: DataFrame, settings: str = "job_json") -> DataFrame:
    """Job documents to one flat row of text columns each."""
    return jobs.select(*[F.get_json_object(settings, path).alias(name) for name, path in JOB_SETTING_PATHS.items()])


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()):
    for f in schema.fields:
        here = path + (f.name,)
        if isinstance(f.dataType, T.StructType):
            yield from _leaves(f.dataType, here)
        else:
            yield here, f.dataType


def flatten_nested(df: DataFrame) -> DataFrame:
    """Struct fields as dotted top-level columns; arrays and maps stay as JSON text."""
    columns = []
    for path, kind in _leaves(df.schema):
        source = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(kind, (T.ArrayType, T.MapType)):
            source = F.to_json(source)
        columns.append(source.alias(".".join(path)))
    return df.select(columns)


def catalog_rows(tables: DataFrame, wanted) -> DataFrame:
    """Flat catalog metadata: wanted columns that exist, ``last_dq_checked`` set to false."""
    flat = flatten_nested(tables).withColumn("last_dq_checked", F.lit(False))
    return flat.select([F.col(f"`{c}`") for c in wanted if c in flat.columns])
