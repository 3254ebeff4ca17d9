"""Error logs: parsing, grouping and numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import one_line, run_label, strip
from .blocks import carry_forward, integer_block, running_index
from .layout import stage

# Log line patterns and defaults.
JOB_ID_PATTERN = r"ID:\s*(\d+)"
RUN_HEADER_PATTERN = r"Run\s*\d+:\s*ID=(\d+).*?Start=([0-9\-: ]+)"
ERROR_LINE_PATTERN = r"^\[(.*?)\]\s*(\d+)\s*-\s*ERROR\s*-\s*([\w\-.]+)\s*-\s*(.+)"
TASK_MESSAGE_PATTERN = r"Task\s*\[([^\]]+)\]\s*run_id=(\d+)\s*ERROR:\s*(.+)"
SOURCE_PATTERN = r"Task ([\w\-]+)"
UNKNOWN_JOB = "UNKNOWN"
FIRST_GROUP_NUMBER = 100


_MARK = "\u0001"


def _parts(text: Column, pattern: str, *groups: int) -> Column:
    """Several groups of a pattern from one match: rewritten to marked text, then split.

    Only the last group may contain the mark, and the split leaves it whole.
    """
    marked = F.regexp_replace(text, pattern, _MARK.join(f"${g}" for g in groups))
    return F.split(marked, _MARK, len(groups))


def parse_error_log(lines: DataFrame, source: str = "source", order: str = "line_no", line: str = "line",
                    block: Column | None = None) -> DataFrame:
    """Error lines as ``(source, line_no, runs, job_id, task_name, message)``.

    A run header sets run id and start for the lines after it, a run id inside the message overrides the carried one,
    the first job id of a source applies to the whole source.  Lines that are none of these are dropped before
    the shuffle.  A source may be of any size: it is worked on in blocks of consecutive lines (``block``; for line
    numbers, ranges of them; for files, the input split from :func:`strataflow.sources.files.read_log_lines`).  The matched
    lines, usually a small part of a log, are stored once because two branches of the plan read them.
    """
    cut = integer_block(F.col(order)) if block is None else block
    body, message = F.col("_text"), F.col("_message")
    kind = F.when(body.rlike(RUN_HEADER_PATTERN), "header").when(body.rlike(ERROR_LINE_PATTERN), "error") \
        .when(body.rlike(JOB_ID_PATTERN), "job")
    rows = lines.select(source, order, strip(F.col(line)).alias("_text"), cut.alias("_cut")) \
        .withColumn("_kind", kind).filter(F.col("_kind").isNotNull())
    header = F.when(F.col("_kind") == "header", _parts(body, rf"^.*?{RUN_HEADER_PATTERN}.*$", 1, 2))
    error = F.when(F.col("_kind") == "error", _parts(body, ERROR_LINE_PATTERN, 3, 4))
    rows = rows.select(source, order, "_cut", "_kind", header.alias("_h"), error.alias("_e"),
                       F.nullif(F.regexp_extract(body, JOB_ID_PATTERN, 1), F.lit("")).alias("_job_id"))
    rows = rows.withColumn("_message", strip(F.get("_e", F.lit(1))))
    inner = F.when(message.rlike(TASK_MESSAGE_PATTERN), _parts(message, rf"^.*?{TASK_MESSAGE_PATTERN}$", 1, 2, 3))
    rows = stage(rows.withColumn("_t", inner).select(
        source, order, "_cut", "_job_id", (F.col("_kind") == "error").alias("_is_error"),
        F.when(F.col("_h").isNotNull(), F.struct(F.get("_h", F.lit(0)).alias("run_id"),
                                                 strip(F.get("_h", F.lit(1))).alias("start"))).alias("_header"),
        F.get("_t", F.lit(1)).alias("_run_id"),
        F.coalesce(strip(F.get("_t", F.lit(0))), F.get("_e", F.lit(0))).alias("task_name"),
        F.coalesce(strip(F.get("_t", F.lit(2))), message).alias("message")), "log-lines")
    carried = carry_forward(rows, [source], order, F.col("_cut"), {"_run": F.col("_header")}, {"_job": F.col("_job_id")})
    run_id = F.coalesce("_run_id", F.col("_run.run_id"))
    return carried.filter("_is_error").select(
        source, order, run_label(run_id, F.col("_run.start")).alias("runs"), F.coalesce("_job", F.lit(UNKNOWN_JOB)).alias("job_id"),
        "task_name", "message")


GROUP_KEYS = ["job_id", "task_name", "message"]


def error_labels(parsed: DataFrame) -> DataFrame:
    """The distinct run labels of every job, task and message, one row each: ``(job_id, task_name, message, runs)``."""
    return parsed.select(*GROUP_KEYS, "runs").distinct()


def group_errors(labels: DataFrame) -> DataFrame:
    """Errors by job, task and message: ``(job_id, task_name, message, n_runs)``, one row per group of any size.

    The labels themselves stay a table (:func:`error_labels`): a group may have any number of them.
    """
    return labels.groupBy(*GROUP_KEYS).agg(F.count(F.lit(1)).alias("n_runs"))


def number_error_groups(errors: DataFrame, job: str = "job_id", order: str = "ord", task: str = "task_key",
                        error: str = "error_text", block_rows: int = 1 << 16) -> DataFrame:
    """Number the error sources of each job and the errors within each source.

    The source is the task named in the error text, else the task key.  Groups get numbers from 100 in order of first
    appearance within the job; ``error_index`` counts from 1 within the group.  ``order`` is a unique integer.  Null jobs and
    sources are groups like others.

    Rows are shuffled once and stored with their places; all numbering works on one head row per (job, source, block).
    """
    text = one_line(F.col(error))
    named = F.nullif(F.regexp_extract(text, SOURCE_PATTERN, 1), F.lit(""))
    rows = errors.filter(F.col(error).isNotNull() & (F.col(error) != "")).withColumn("message", text) \
        .withColumn("source", F.coalesce(named, F.col(task))).drop(error)
    inside = Window.partitionBy(job, "source", "_block")
    # The one shuffle of all rows: place in the block, and the block's size and first row.
    rows = stage(rows.withColumn("_block", integer_block(F.col(order), block_rows)).withColumns({
        "_local": F.row_number().over(inside.orderBy(order)), "_n": F.count(F.lit(1)).over(inside)}), "numbering")
    heads = rows.where("_local = 1").select(job, "source", "_block", F.col(order).alias("_at"), "_n")
    group = Window.partitionBy(job, "source")
    placed = heads.withColumns({
        "_first": F.min("_at").over(group),
        "_before": F.coalesce(F.sum("_n").over(group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    groups = placed.where("_at = _first").select(F.col(job).alias("_job"), "_first")
    numbered = running_index(groups, ["_job"], ["_first"], integer_block(F.col("_first"), block_rows), "group_no", FIRST_GROUP_NUMBER)
    # The first row of a group names it, as orders are unique.
    numbers = placed.join(numbered.withColumnRenamed("_first", "_named"), F.col("_first") == F.col("_named")).select(
        F.col(job).alias("_job"), F.col("source").alias("_source"), F.col("_block").alias("_place"), "_before", "group_no")
    same = F.col(job).eqNullSafe(F.col("_job")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("_place"))
    indexed = rows.join(numbers, same).withColumn("error_index", (F.col("_local") + F.col("_before")).cast("bigint"))
    return indexed.drop("_block", "_local", "_n", "_job", "_source", "_place", "_before")
