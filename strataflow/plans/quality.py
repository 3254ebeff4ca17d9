"""Quality runs: catalog-driven checks of tables, and rule-driven repair of a file."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.checks import parse_metadata, rules_of_row, tables_to_check, tag_table, validate_table
from ..operators.layout import scratch
from ..operators.metrics import issue_counts, quality_report
from ..operators.rules import (RuleSet, analyze, column_analysis, outcome, repair, repair_log, replace_corrupted,
                               required_completeness)
from ..operators.upsert import stamp_checked
from ..sources.files import read_rule_input
from ..sources.lake import read_table
from ..sources.sinks import export, write_json


OUTCOME = "table_id string, full_name string, state string, n_issues long, message string"


def check_tables(spark: SparkSession, tables: DataFrame, out: str, now_epoch: int, load=None, row_ids=None,
                 patterns: dict | None = None, parallel: int = 4) -> DataFrame:
    """Check every due table; issues, reports and outcomes are written below ``out``.

    ``tables`` has ``table_id, full_name, metadata, updated_at, last_dq_checked``.  ``load(full_name)`` reads a table (default:
    by catalog name); ``row_ids`` maps a table's name to its key column.  The issues of a table are written first and the report
    reads them back, so the data is checked once.  Metrics describe the unmasked data.

    ``parallel`` tables are worked on at a time, each in a scheduler pool of its own, so that a session with fair scheduling
    shares its executors among them and a small table does not wait for a large one.  A table that cannot be read or checked
    stops no other: ``out/outcome`` has a row for each due table, ``checked`` or ``failed`` with the reason.  Returns the table
    list with the check time stamped on the checked ones only; the caller stores it.
    """
    load = load or (lambda name: read_table(spark, name))
    due = tables_to_check(tables)

    def check(row) -> int:
        rules, name = rules_of_row(row), row.full_name
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"quality-{row.table_id}")
        df = load(name)
        issues_path = f"{out}/issues/table_id={row.table_id}"
        found = validate_table(df, rules, (row_ids or {}).get(name), (patterns or {}).get(name), rules["pii_columns"] or None)
        found.write.mode("overwrite").parquet(issues_path)
        stored = spark.read.schema(found.schema).parquet(issues_path)
        with scratch(spark):
            write_json(tag_table(quality_report(df, stored, is_stored=True), row.table_id), f"{out}/report/table_id={row.table_id}")
        return stored.count()

    def outcome_of(row) -> tuple:
        try:
            return row.table_id, row.full_name, "checked", check(row), None
        except Exception as problem:  # whatever is wrong with one table is its outcome, not the end of the run
            return row.table_id, row.full_name, "failed", None, str(problem).split("\n", 1)[0][:500]

    # The list of due tables is catalog metadata, read and decoded once: a row and a list of columns per table.
    rows = parse_metadata(due.select("table_id", "full_name", "metadata")).collect()
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        # Every table starts from its own copy of the caller's local properties: one copy for all would share the pool set last.
        work = [inheritable_thread_target(spark)(outcome_of) for _ in rows]
        outcomes = list(pool.map(lambda run, row: run(row), work, rows))
    kind = due.schema["table_id"].dataType.simpleString()
    result = spark.createDataFrame(outcomes, OUTCOME.replace("table_id string", f"table_id {kind}"))
    write_json(result, f"{out}/outcome")
    return stamp_checked(tables, result.where("state = 'checked'").select("table_id"), now_epoch)


def repair_table(df: DataFrame, config: dict, row_id: str, flags: dict | None = None) -> dict[str, DataFrame]:
    """Everything a rule run yields, as frames over one cleaned input."""
    rules = RuleSet(config)
    cleaned = replace_corrupted(df, rules)
    issues = analyze(cleaned, rules, row_id)
    fixed = repair(cleaned, rules, flags)
    log = repair_log(cleaned, rules, row_id, flags)
    return {"issues": issues, "summary": issue_counts(issues), "analysis": column_analysis(issues, rules), "fixed": fixed,
            "log": log, "completeness": required_completeness(fixed, rules), "outcome": outcome(issues, log)}


def repair_file(spark: SparkSession, path: str, config: dict, out: str, row_id: str | None = None,
                flags: dict | None = None, fmt: str = "csv", schema=None) -> dict[str, DataFrame]:
    """Read a CSV file, replace corrupted values, find issues, repair them and export the result.

    Without a key column rows get an id that is fixed by storing the cleaned input first.
    """
    rules = RuleSet(config)
    source = replace_corrupted(read_rule_input(spark, path, schema), rules)
    key = row_id or "_row_id"
    staged = source if row_id else source.withColumn(key, F.monotonically_increasing_id())
    staged.write.mode("overwrite").parquet(f"{out}/input.parquet")
    cleaned = spark.read.schema(staged.schema).parquet(f"{out}/input.parquet")
    issues, log = analyze(cleaned, rules, key), repair_log(cleaned, rules, key, flags)
    issues.write.mode("overwrite").parquet(f"{out}/issues.parquet")
    log.write.mode("overwrite").parquet(f"{out}/fix_log.parquet")
    issues = spark.read.schema(issues.schema).parquet(f"{out}/issues.parquet")
    log = spark.read.schema(log.schema).parquet(f"{out}/fix_log.parquet")
    fixed = repair(cleaned, rules, flags)
    export(fixed if row_id else fixed.drop(key), f"{out}/cleaned.{fmt}")
    write_json(issue_counts(issues), f"{out}/issue_summary.json")
    return {"issues": issues, "summary": issue_counts(issues), "analysis": column_analysis(issues, rules), "fixed": fixed,
            "log": log, "completeness": required_completeness(fixed, rules), "outcome": outcome(issues, log)}
