"""Error log to report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.diagnose import (CLASSIFICATION_LABELS, DIAGNOSIS_LABELS, diagnosis_text, error_report, parse_labels)
from ..operators.layout import stage
from ..operators.logs import error_labels, group_errors, parse_error_log
from ..sources.files import newest_file, read_log_lines
from ..sources.sinks import write_report

_KEYS = ["task_name", "message"]


def diagnosed_groups(groups: DataFrame, classifications: DataFrame, diagnoses: DataFrame, text: str = "response") -> DataFrame:
    """Error groups with the parsed answers for their (task, message)."""
    kinds = parse_labels(classifications, text, CLASSIFICATION_LABELS, *_KEYS)
    details = parse_labels(diagnoses, text, DIAGNOSIS_LABELS, *_KEYS).select(
        *_KEYS, F.col("severity").alias("severity_score"),
        diagnosis_text(*[F.col(c) for c in ("summary", "root_cause", "next_steps", "action_owner")]).alias("diagnosis"))
    return groups.join(kinds, _KEYS, "left").join(details, _KEYS, "left")


def report_of(lines: DataFrame, classifications: DataFrame, diagnoses: DataFrame, **log_columns) -> DataFrame:
    """Report rows for log lines and response tables."""
    labels = stage(error_labels(parse_error_log(lines, **log_columns)), "error-labels")
    return error_report(diagnosed_groups(group_errors(labels), classifications, diagnoses), labels)


def run(spark: SparkSession, log_folder: str, classifications: DataFrame, diagnoses: DataFrame, out: str) -> str | None:
    """Report on the newest log file; returns its path, or ``None`` for an empty folder."""
    path = newest_file(spark, log_folder)
    if path is None:
        return None
    lines = read_log_lines(spark, path)
    write_report(report_of(lines, classifications, diagnoses, block=F.col("block")), out)
    return path
