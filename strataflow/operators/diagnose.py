"""Error classification answers, diagnoses, routing and reports.

The texts come from a table of responses; no service is called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import labelled_value
from .blocks import running_index
from .layout import stage

# Labels, defaults, categories and routes.
CLASSIFICATION_LABELS = {
    "error_type": ("ERROR_TYPE", "OTHER_ERROR"),
    "confidence": ("CONFIDENCE", "Low"),
    "reason": ("REASON", "Could not parse"),
}
DIAGNOSIS_LABELS = {
    "summary": ("SUMMARY", ""),
    "root_cause": ("ROOT_CAUSE", ""),
    "next_steps": ("NEXT_STEPS", ""),
    "severity": ("SEVERITY", "Medium"),
    "action_owner": ("ACTION_OWNER", ""),
}
REPORT_ACTION_OWNER = "Data Engineer"
ERROR_CATEGORIES = ("TYPE_ERROR", "VALUE_ERROR", "RESOURCE_ERROR", "NETWORK_ERROR", "PERMISSION_ERROR",
                    "CONFIGURATION_ERROR", "DEPENDENCY_ERROR", "CLUSTER_ERROR", "OTHER_ERROR", "NO_ERROR")
DATA_QUALITY_ERRORS = ("TYPE_ERROR", "VALUE_ERROR")
RESTART_ERRORS = ("CLUSTER_ERROR",)
DEFAULT_ERROR_TYPE = "OTHER_ERROR"


def parse_labels(responses: DataFrame, text: str, labels: dict[str, tuple[str, str]], *keep) -> DataFrame:
    """``LABEL: value`` texts to columns with defaults."""
    return responses.select(*keep, *[labelled_value(F.col(text), label, default).alias(name)
                                     for name, (label, default) in labels.items()])


def diagnosis_text(summary: Column, root_cause: Column, next_steps: Column, owner: Column) -> Column:
    return F.format_string("Summary: %s\nRoot Cause: %s\nNext Steps: %s\nAction Owner: %s",
                           summary, root_cause, next_steps, owner)


def merge_diagnosis(task_runs: DataFrame, classifications: DataFrame, diagnoses: DataFrame,
                    text: str = "response") -> DataFrame:
    """Diagnosis rows from the two response tables, keyed by ``task_run_id``.

    Every classified task gets a row; the diagnosis part is null for a task that has no run or no diagnosis response.
    """
    classified = parse_labels(classifications, text, CLASSIFICATION_LABELS, "task_run_id")
    parsed = parse_labels(diagnoses, text, DIAGNOSIS_LABELS, "task_run_id")
    runs = task_runs.select("task_run_id", "job_id", F.col("run_id").alias("job_run_id"))
    detail = runs.join(parsed, "task_run_id").select(
        "task_run_id", diagnosis_text(*[F.col(c) for c in ("summary", "root_cause", "next_steps", "action_owner")]).alias("diagnosis"),
        F.col("severity").alias("severity_score"), "job_id", "job_run_id")
    return classified.join(detail, "task_run_id", "left")


def error_type_counts(errors: DataFrame) -> DataFrame:
    kind = F.coalesce(F.col("error_type"), F.lit(DEFAULT_ERROR_TYPE)).alias("error_type")
    return errors.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))


def route_remediation(errors: DataFrame, job: str = "job_id") -> DataFrame:
    """What each job's errors call for: a data-quality run, a cluster restart, both or nothing."""
    def has(kinds):
        return F.coalesce(F.bool_or(F.col("error_type").isin(*kinds)), F.lit(False))
    needs = errors.groupBy(job).agg(has(DATA_QUALITY_ERRORS).alias("needs_data_quality"),
                                    has(RESTART_ERRORS).alias("needs_cluster_restart"))
    steps = F.array_compact(F.array(F.when(F.col("needs_data_quality"), F.lit("data_quality")),
                                    F.when(F.col("needs_cluster_restart"), F.lit("cluster_restart"))))
    route = F.when(F.size(steps) == 0, F.lit("none")).otherwise(F.array_join(steps, ","))
    return needs.withColumn("route", route)


def task_report_blocks(task_runs: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """One text block per task run: ``(job_id, task_run_id, block_text)``."""
    found = diagnosis.select("task_run_id", "error_type", "severity_score", "diagnosis")
    joined = task_runs.select("job_id", "task_run_id", "task_name", "error_message").join(found, "task_run_id", "left")
    text = F.format_string("Task: %s (%s)\nError: %s\nType: %s (%s)\nDiagnosis: %s\n" + "-" * 40,
                           "task_name", F.col("task_run_id").cast("string"), "error_message", "error_type",
                           "severity_score", "diagnosis")
    return joined.select("job_id", "task_run_id", text.alias("block_text"))


def error_report(groups: DataFrame, labels: DataFrame, job: str = "job_id") -> DataFrame:
    """The error report of every job as ordered text rows ``(job_id, section, seq, line, text)``.

    Sections: 0 heading, 1 summary by error type, 2 the error groups: line 0 is a group's head, line 1 one row per run label,
    line 2 its message and diagnosis.  ``groups`` has one row per (job, task, message) with ``error_type``, ``severity_score`` and
    ``diagnosis``; ``labels`` one row per group and run.  The report stays rows, sorted by all of its columns when written, so
    neither a job nor a group of any size ever becomes one value.
    """
    keys = [job, "task_name", "message"]
    # Groups are numbered in the order of their keys: range partitions of the sorted keys are the blocks of the numbering.
    ranged = groups.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id())
    groups = stage(ranged, "error-groups")
    numbered = running_index(groups, [job], ["task_name", "message"], F.col("_range"), "seq").drop("_range")
    kind = F.coalesce(F.col("error_type"), F.lit(DEFAULT_ERROR_TYPE))
    zero = F.lit(0).cast("bigint")
    heading = groups.select(job).distinct().select(
        job, F.lit(0).alias("section"), zero.alias("seq"), F.lit(0).alias("line"),
        F.concat(F.lit("Job ID: "), F.col(job).cast("string"), F.lit("\n\nError Summary:")).alias("text"))
    counts = groups.groupBy(job, kind.alias("error_type")).agg(F.count(F.lit(1)).alias("n"))
    # Few error types per job: a plain window over the counts is small.
    summary = counts.select(job, F.lit(1).alias("section"),
                            F.row_number().over(Window.partitionBy(job).orderBy("error_type")).cast("bigint").alias("seq"), F.lit(0).alias("line"),
                            F.concat(F.lit("- "), F.col("error_type"), F.lit(": "), F.col("n").cast("string")).alias("text"))
    numbered = stage(numbered, "numbered-groups")
    head = F.format_string("Error Group %d [%s - %s]\nTask: %s", F.col("seq"), kind, F.coalesce("severity_score", F.lit("Medium")), F.col("task_name"))
    tail = F.format_string("Message: %s\nDiagnosis: %s", F.col("message"), F.coalesce("diagnosis", F.lit("No diagnosis available.")))
    body = numbered.select(job, F.lit(2).alias("section"), "seq", F.inline(F.array(
        F.struct(F.lit(0).alias("line"), head.alias("text")), F.struct(F.lit(2).alias("line"), tail.alias("text")))))
    runs = labels.join(numbered.select(*keys, "seq"), keys).select(
        job, F.lit(2).alias("section"), "seq", F.lit(1).alias("line"), F.concat(F.lit("Run: "), "runs").alias("text"))
    return heading.unionByName(summary).unionByName(body).unionByName(runs)
