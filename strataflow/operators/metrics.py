"""Quality metrics, issue counts and reports as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from .checks import CellCheck, cell_text
from .layout import stage
from ..functions.text import any_of


def percent(part: Column, total: Column) -> Column:
    """Percentage with two decimals; 0 for an empty table."""
    return F.when(total > 0, F.bround(part / total * 100, 2)).otherwise(F.lit(0.0))


def _value_key(df: DataFrame, name: str) -> Column:
    """Text that is equal exactly when two cells are equal.  Texts travel as their SHA-256: of one width, whatever their length."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return (F.col(f"`{name}`") + F.lit(0.0).cast(kind)).cast("string")
    text = cell_text(df, name)
    if isinstance(kind, (T.StringType, T.ArrayType, T.MapType, T.StructType)):
        return F.sha2(text, 256)
    return text


def column_profile(df: DataFrame, columns=None, approximate: bool = False, flags: dict[str, Column] | None = None) -> DataFrame:
    """``(column, total_rows, non_null, distinct_values, flagged)`` per column; ``flags`` marks the rows a column's checks reject.

    Exact by default: cells are counted by (column, value) with map-side combining, so a value held by a third of
    the rows reaches the shuffle once per task, and the second step only counts the distinct values.
    ``approximate`` swaps in a sketch and needs no shuffle of values.
    """
    names, flags = list(columns if columns is not None else df.columns), flags or {}
    if approximate:
        total = F.count(F.lit(1))
        wide = df.agg(*[F.struct(F.lit(c).alias("column"), total.alias("total_rows"),
                                 F.count(f"`{c}`").alias("non_null"),
                                 F.approx_count_distinct(_value_key(df, c)).alias("distinct_values"),
                                 F.count_if(flags[c] if c in flags else F.lit(False)).alias("flagged")).alias(f"c{i}")
                        for i, c in enumerate(names)])
        return wide.select(F.inline(F.array(*[F.col(f"c{i}") for i in range(len(names))])))
    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("position"), _value_key(df, c).alias("value"),
                 (flags[c] if c in flags else F.lit(False)).alias("flag")) for i, c in enumerate(names)])))
    per_value = cells.groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("flag").alias("bad"))
    per_column = per_value.groupBy("position").agg(
        F.sum("n").alias("total_rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
        F.count("value").alias("distinct_values"), F.sum("bad").alias("flagged"))
    # The list of columns keeps an empty table's columns in the result.
    listing = df.sparkSession.createDataFrame(list(enumerate(names)), "position int, `column` string")
    counted = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in ("total_rows", "non_null", "distinct_values", "flagged")]
    return listing.join(per_column, "position", "left").select("column", *counted)


def flagged_rows(issues: DataFrame) -> DataFrame:
    """Distinct flagged rows per column; table-level issues carry no row and do not count."""
    return issues.filter(F.col("row_id").isNotNull()).select("column", "row_id").distinct() \
        .groupBy("column").agg(F.count(F.lit(1)).alias("flagged"))


def check_flags(checks: list[CellCheck]) -> dict[str, Column]:
    """Per column, whether any of its checks rejects the row."""
    by_column: dict[str, list[Column]] = {}
    for check in checks:
        by_column.setdefault(check.column, []).append(F.coalesce(check.flagged, F.lit(False)))
    return {c: any_of(tests) for c, tests in by_column.items()}


def flagged_by_checks(df: DataFrame, checks: list[CellCheck]) -> DataFrame:
    """The same numbers straight from the checks: one aggregation, no shuffle of row ids."""
    by_column = check_flags(checks)
    names = list(by_column)
    wide = df.agg(*[F.count_if(by_column[c]).alias(f"c{i}") for i, c in enumerate(names)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("flagged"))
                                          for i, c in enumerate(names)])))


def metrics_of(profile: DataFrame) -> DataFrame:
    """Completeness, uniqueness and validity percentages from a profile."""
    total = F.col("total_rows")
    return profile.select("column",
                          percent(F.col("non_null"), total).alias("completeness_pct"),
                          percent(F.col("distinct_values"), total).alias("uniqueness_pct"),
                          percent(total - F.col("flagged"), total).alias("validity_pct"))


def quality_metrics(df: DataFrame, flagged: DataFrame, columns=None, approximate: bool = False) -> DataFrame:
    """Completeness, uniqueness and validity percentages per column, for flags that come as a table."""
    profile = column_profile(df, columns, approximate).drop("flagged").join(flagged, "column", "left")
    return metrics_of(profile.withColumn("flagged", F.coalesce("flagged", F.lit(0))))


def checked_metrics(df: DataFrame, checks: list[CellCheck], columns=None, approximate: bool = False) -> DataFrame:
    """The same for checks on the rows themselves: values and flags are counted in one scan and one shuffle."""
    return metrics_of(column_profile(df, columns, approximate, check_flags(checks)))


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("column", "issue").agg(F.count(F.lit(1)).alias("n"))


def column_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(F.sum("n").alias("total_issues"))


METRICS = ("completeness_pct", "uniqueness_pct", "validity_pct")


def quality_report(df: DataFrame, issues: DataFrame, columns=None, is_stored: bool = False) -> DataFrame:
    """The report as rows ``(section, column, item, number)``, for issues that come as a table.

    Sections: ``summary`` (total rows, total issues), ``issues_by_column`` and ``quality_metrics``.  ``issues`` is read
    several times; unless it ``is_stored`` already, its keys are stored first so that the data is checked once.  The profile,
    a row per column, is stored too: the table itself is scanned once.  For checks on the rows see :func:`checked_report`.
    """
    issues = issues.select("row_id", "column", "issue")
    if not is_stored:
        issues = stage(issues, "issues")
    profile = stage(column_profile(df, columns).drop("flagged"), "profile")
    flagged = profile.join(flagged_rows(issues), "column", "left").withColumn("flagged", F.coalesce("flagged", F.lit(0)))
    metrics = metrics_of(flagged).select(
        F.lit("quality_metrics").alias("section"), "column",
        F.inline(F.array(*[F.struct(F.lit(m).alias("item"), F.col(m).alias("number")) for m in METRICS])))
    counts = issue_counts(issues)
    by_column = counts.select(F.lit("issues_by_column").alias("section"), "column", F.col("issue").alias("item"),
                              F.col("n").cast("double").alias("number"))
    none = F.lit(None).cast("string").alias("column")
    rows = profile.agg(F.coalesce(F.max("total_rows"), F.lit(0)).alias("n")).select(
        F.lit("summary").alias("section"), none, F.lit("total_rows").alias("item"), F.col("n").cast("double").alias("number"))
    total = issues.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("summary").alias("section"), none, F.lit("total_issues").alias("item"), F.col("n").cast("double").alias("number"))
    return rows.unionByName(total).unionByName(by_column).unionByName(metrics)


def checked_report(df: DataFrame, checks: list[CellCheck], columns=None) -> DataFrame:
    """The same report for checks on the rows themselves: one plan with one scan, and nothing is stored.

    Cells are counted by (column, value) together with what each of the column's checks rejects, so one map-side combined
    shuffle carries values, flags and issues.  From there on there is a row per column.  Rows are counted, not row ids: rows
    that share an id are flagged one by one.  An empty table has zeros; a check whose column is not in ``columns`` is refused.
    """
    names = list(columns if columns is not None else df.columns)
    by_column: dict[str, dict[str, list[Column]]] = {c: {} for c in names}
    for check in checks:
        if check.column not in by_column:
            raise ValueError(f"no column {check.column!r} to check")
        by_column[check.column].setdefault(check.issue, []).append(F.coalesce(check.flagged, F.lit(False)))
    # A column's issues have places 0, 1, ... of which all columns share the counters.
    places = max((len(issues) for issues in by_column.values()), default=0)
    zero, number = F.lit(0).cast("bigint"), lambda tests: sum((t.cast("bigint") for t in tests[1:]), tests[0].cast("bigint"))

    def cell(i: int, c: str) -> Column:
        tests = list(by_column[c].values())
        flag = any_of([t for group in tests for t in group]) if tests else F.lit(False)
        return F.struct(F.lit(i).alias("position"), _value_key(df, c).alias("value"), flag.alias("flag"),
                        *[(number(tests[k]) if k < len(tests) else zero).alias(f"i{k}") for k in range(places)])

    cells = df.select(F.inline(F.array(*[cell(i, c) for i, c in enumerate(names)])))
    sums = [F.sum(f"i{k}").alias(f"i{k}") for k in range(places)]
    per_value = cells.groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("flag").alias("bad"), *sums)
    per_column = per_value.groupBy("position").agg(
        F.sum("n").alias("total_rows"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("non_null"),
        F.count("value").alias("distinct_values"), F.sum("bad").alias("flagged"), *sums)
    listing = df.sparkSession.createDataFrame(
        [(i, c, list(by_column[c])) for i, c in enumerate(names)], "position int, `column` string, issues array<string>")
    counters = ["total_rows", "non_null", "distinct_values", "flagged", *[f"i{k}" for k in range(places)]]
    counted = listing.join(per_column, "position", "left").select(
        "column", "issues", *[F.coalesce(F.col(c), zero).alias(c) for c in counters])
    found = F.array(*[F.col(f"i{k}") for k in range(places)]) if places else F.array().cast("array<bigint>")
    total = F.col("total_rows")
    shares = dict(zip(METRICS, (percent(F.col("non_null"), total), percent(F.col("distinct_values"), total), percent(total - F.col("flagged"), total))))

    def line(section: str, column: Column, item: Column, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), column.alias("column"), item.alias("item"), value.cast("double").alias("number"))

    issue_lines = F.transform(F.col("issues"), lambda name, k: line("issues_by_column", F.col("column"), name, F.get(found, k)))
    lines = F.concat(F.filter(issue_lines, lambda x: x["number"] > 0),
                     F.array(*[line("quality_metrics", F.col("column"), F.lit(m), v) for m, v in shares.items()]))
    # One row from as many as the table has columns.
    whole = counted.agg(F.max("total_rows").alias("rows"), F.sum(F.aggregate(found, zero, lambda a, x: a + x)).alias("all"),
                        F.flatten(F.collect_list(lines)).alias("lines"))
    none = F.lit(None).cast("string")
    summary = F.array(line("summary", none, F.lit("total_rows"), F.coalesce("rows", zero)),
                      line("summary", none, F.lit("total_issues"), F.coalesce("all", zero)))
    return whole.select(F.inline(F.concat(summary, F.col("lines"))))


def longest_text(df: DataFrame, columns=None, sample_rows: int | None = None, order=None) -> DataFrame:
    """Longest text per column; over the first ``sample_rows`` rows of ``order`` when a sample is asked for."""
    names = list(columns if columns is not None else df.columns)
    rows = df if sample_rows is None else (df.orderBy(*order) if order else df).limit(sample_rows)
    wide = rows.agg(*[F.max(F.length(cell_text(df, c))).alias(f"c{i}") for i, c in enumerate(names)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").cast("bigint").alias("max_length")) for i, c in enumerate(names)])))


def completeness_of(df: DataFrame, fields) -> DataFrame:
    """Share of non-null cells of the required fields that exist."""
    names = [f for f in fields if f in df.columns]
    if not names:
        return df.sparkSession.createDataFrame([], "`column` string, completeness double")
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])
    share = [F.struct(F.lit(c).alias("column"),
                      F.when(F.col("rows") > 0, F.col(f"c{i}") / F.col("rows") * 100).alias("completeness"))
             for i, c in enumerate(names)]
    return wide.select(F.inline(F.array(*share)))
