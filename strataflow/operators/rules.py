"""Rule-driven validation and repair of text columns.

A rule configuration is a plain dict compiled to Column expressions.  Because every rule and every replacement is known when
the plan is built, finding issues, repairing cells and writing the repair log are narrow maps without shuffle
or join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import to_double
from ..functions.semantic import LATITUDE_RANGE, LONGITUDE_RANGE, fits_semantic_type
from ..functions.text import is_mostly_special, is_non_ascii, matches_prefix
from .checks import row_key
from .metrics import column_totals, completeness_of, issue_counts, longest_text

# Fixed values.
CORRUPTED_TEXT = "corrupted data"
NO_STRATEGY = "N/A"
TYPES_CHECKED_FOR_CORRUPTION = ("phone", "latlong", "url", "email")
OPEN_UNLESS_CLOSED = ("min_value_violation", "max_value_violation", "excessive_special_chars")
CONSTRAINT_ORDER = ("required_missing", "min_length_violation", "max_length_violation", "min_value_violation",
                    "max_value_violation", "pattern_violation", "invalid_value", "corrupt_characters",
                    "excessive_special_chars")
DEFAULT_MIN_LENGTH = 3
DEFAULT_PHONE_PATTERNS = (r"^\+?[1-9][0-9]{9,14}$",)
DEFAULT_URL_DOMAINS = (".com", ".in", ".org", ".net")


class RuleSet:
    """Column rules, repair strategies and custom type rules of a dataset."""

    def __init__(self, config: dict):
        self.rules = config.get("validation_rules", {})
        self.strategies = config.get("fix_strategies", {})
        self.custom = config.get("custom_validation_rules", {})
        self.quality = config.get("quality_metrics", {})

    def columns_of(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c in self.rules]

    def type_of(self, column: str) -> str:
        return self.rules.get(column, {}).get("data_type", "string")

    def strategy(self, column: str, issue: str) -> str:
        """Column strategy, else default strategy, else ``N/A``."""
        fallback = self.strategies.get("default", {}).get(issue, NO_STRATEGY)
        return self.strategies.get(column, {}).get(issue, fallback)

    def replacement(self, column: str, issue: str) -> str:
        """The strategy, or the default for the column's type where no strategy is given."""
        chosen = self.strategy(column, issue)
        if chosen != NO_STRATEGY:
            return chosen
        return self.strategies.get("default", {}).get(f"invalid_{self.type_of(column)}", NO_STRATEGY)

    def _constraints(self, column: str) -> dict[str, Column]:
        rules = self.rules[column]
        cell = F.col(f"`{column}`")
        text, number = cell.cast("string"), to_double(cell)
        numeric = self.type_of(column) in ("integer", "float") and "data_type" in rules
        found: dict[str, Column] = {}
        if rules.get("required"):
            found["required_missing"] = cell.isNull()
        if "min_length" in rules:
            found["min_length_violation"] = F.length(text) < rules["min_length"]
        if "max_length" in rules:
            found["max_length_violation"] = F.length(text) > rules["max_length"]
        if numeric and "min_value" in rules:
            found["min_value_violation"] = number < rules["min_value"]
        if numeric and "max_value" in rules:
            found["max_value_violation"] = number > rules["max_value"]
        if "pattern" in rules:
            found["pattern_violation"] = ~matches_prefix(text, rules["pattern"])
        if "allowed_values" in rules:
            found["invalid_value"] = ~cell.isin(*rules["allowed_values"])
        if rules.get("check_corruption"):
            found["corrupt_characters"] = is_non_ascii(text)
            found["excessive_special_chars"] = is_mostly_special(text)
        return {issue: found[issue] for issue in CONSTRAINT_ORDER if issue in found}

    def cell_tests(self, column: str) -> list[tuple[str, Column]]:
        """Ordered ``(issue, predicate)`` pairs of a column: the type first, then the constraints."""
        cell = F.col(f"`{column}`")
        kind = self.type_of(column)
        wrong_type = cell.isNotNull() & ~fits_semantic_type(cell, kind, self.custom)
        return [(f"invalid_{kind}", wrong_type), *self._constraints(column).items()]

    def is_corrupted(self, column: str) -> Column:
        """Cells whose content cannot be trusted at all."""
        rules = self.rules[column]
        cell = F.col(f"`{column}`")
        text, kind = cell.cast("string"), self.type_of(column)
        bad = F.lit(False)
        if rules.get("check_corruption"):
            bad = bad | is_non_ascii(text) | is_mostly_special(text)
        if kind == "string" and rules.get("pattern"):
            bad = bad | ~matches_prefix(text, rules["pattern"])
        if kind in TYPES_CHECKED_FOR_CORRUPTION:
            bad = bad | ~fits_semantic_type(cell, kind, self.custom)
        return cell.isNotNull() & bad


def gate_open(flags: dict | None, column: str, issue: str) -> bool:
    """May this issue of this column be repaired?  Without flags everything may."""
    if flags is None:
        return True
    own = flags.get(column, {})
    name = "data_type_issue" if issue.startswith("invalid_") else issue
    return bool(own.get(name, name in OPEN_UNLESS_CLOSED))


def replace_corrupted(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Corrupted cells become the text ``corrupted data``; they are judged as that text afterwards."""
    fixed = {c: F.when(rules.is_corrupted(c), F.lit(CORRUPTED_TEXT)).otherwise(F.col(f"`{c}`").cast("string"))
             for c in rules.columns_of(df)}
    return df.select([fixed[c].alias(c) if c in fixed else F.col(f"`{c}`") for c in df.columns])


def analyze(df: DataFrame, rules: RuleSet, row_id: str | None = None) -> DataFrame:
    """Issue rows ``(row_id, column, ord, issue, value)`` of all configured columns."""
    entries = []
    for column in rules.columns_of(df):
        value = F.col(f"`{column}`").cast("string")
        for position, (issue, flagged) in enumerate(rules.cell_tests(column)):
            entries.append(F.when(flagged, F.struct(
                F.lit(column).alias("column"), F.lit(position).alias("ord"), F.lit(issue).alias("issue"),
                value.alias("value"))))
    return df.select(row_key(df, row_id).alias("row_id"), F.inline(F.array_compact(F.array(*entries))))


def _applied(rules: RuleSet, column: str, flags: dict | None) -> Column:
    """Array of the repairs a cell receives, in order."""
    steps = [F.when(flagged, F.struct(F.lit(issue).alias("issue"), F.lit(position).alias("ord"),
                                      F.lit(str(rules.replacement(column, issue))).alias("new_value")))
             for position, (issue, flagged) in enumerate(rules.cell_tests(column)) if gate_open(flags, column, issue)]
    if not steps:
        return F.lit(None).cast("array<struct<issue:string,ord:int,new_value:string>>")
    return F.array_compact(F.array(*steps))


def repair(df: DataFrame, rules: RuleSet, flags: dict | None = None) -> DataFrame:
    """The table with every repairable cell replaced; the last repair of a cell wins."""
    columns = []
    for c in df.columns:
        cell = F.col(f"`{c}`")
        if c not in rules.rules:
            columns.append(cell)
            continue
        value = cell.cast("string")
        for issue, flagged in rules.cell_tests(c):
            if gate_open(flags, c, issue):
                value = F.when(flagged, F.lit(str(rules.replacement(c, issue)))).otherwise(value)
        columns.append(value.alias(c))
    return df.select(columns)


def repair_log(df: DataFrame, rules: RuleSet, row_id: str | None = None, flags: dict | None = None) -> DataFrame:
    """Every repair ``(row_id, column, ord, issue, old_value, new_value)``.

    ``old_value`` is what the previous repair of the same cell left, or the cell's own value.
    """
    names = rules.columns_of(df)
    # The steps are a column of their own: the old value of a step refers back to them.
    cells = df.select(row_key(df, row_id).alias("row_id"),
                      *[F.col(f"`{c}`").cast("string").alias(f"o{i}") for i, c in enumerate(names)],
                      *[_applied(rules, c, flags).alias(f"s{i}") for i, c in enumerate(names)])

    def entries(i: int, column: str) -> Column:
        return F.transform(f"s{i}", lambda step, at: F.struct(
            F.lit(column).alias("column"), step["ord"].alias("ord"), step["issue"].alias("issue"),
            F.when(at == 0, F.col(f"o{i}")).otherwise(F.get(F.col(f"s{i}"), at - 1)["new_value"]).alias("old_value"),
            step["new_value"].alias("new_value")))

    logs = F.flatten(F.array_compact(F.array(*[entries(i, c) for i, c in enumerate(names)])))
    return cells.select("row_id", F.inline(logs))


def column_analysis(issues: DataFrame, rules: RuleSet) -> DataFrame:
    """Issue counts of every configured column, columns without issues included: ``(column, issue, n, total_issues)``."""
    counts = issue_counts(issues)
    listing = issues.sparkSession.createDataFrame([(c,) for c in rules.rules], "`column` string")
    joined = listing.join(column_totals(counts), "column", "left").join(counts, "column", "left")
    return joined.select("column", "issue", F.coalesce("n", F.lit(0)).alias("n"),
                         F.coalesce("total_issues", F.lit(0)).alias("total_issues"))


def required_completeness(df: DataFrame, rules: RuleSet) -> DataFrame:
    return completeness_of(df, rules.quality.get("completeness", {}).get("required_fields", []))


def outcome(issues: DataFrame, log: DataFrame) -> DataFrame:
    """One row of text: how many repairs over how many columns."""
    both = issues.select(F.lit(True).alias("found"), "column").unionByName(log.select(F.lit(False).alias("found"), "column"))
    counts = both.agg(F.count_if("found").alias("issues"), F.count_if(~F.col("found")).alias("fixes"),
                      F.count_distinct(F.when(F.col("found"), F.col("column"))).alias("columns"))
    text = F.when(F.col("issues") == 0, F.lit("No issues detected. Data is clean.")).otherwise(
        F.format_string("%d issues were fixed across %d columns.", "fixes", "columns"))
    return counts.select(text.alias("outcome"))


def rule_rows(types: DataFrame, required: bool | None = None) -> DataFrame:
    """Rules of columns as rows, from their inferred types (:func:`strataflow.operators.inference.infer_types`): a plan, nothing collected.

    A column without nulls is required, unless ``required`` says so for all; the longest text seen becomes the maximum length.
    """
    needed = F.col("present") == F.col("rows") if required is None else F.lit(required)
    return types.select("column", "data_type", needed.alias("required"), F.lit(True).alias("check_corruption"),
                        F.lit(DEFAULT_MIN_LENGTH).alias("min_length"), F.coalesce("max_length", F.lit(0).cast("bigint")).alias("max_length"))


def rules_of_rows(rows: DataFrame, strategies: dict | None = None) -> dict:
    """The configuration of a table whose types were inferred; one row per column reaches the driver."""
    rules = {r["column"]: {k: r[k] for k in ("data_type", "required", "check_corruption", "min_length", "max_length")} for r in rows.collect()}
    return _configuration(rules, strategies)


def synthesize_rules(df: DataFrame, types: dict[str, str], strategies: dict | None = None,
                     sample_rows: int | None = None, order=None) -> dict:
    """A rule configuration for columns of known types.  The longest text seen becomes the maximum length."""
    lengths = {r["column"]: r.max_length for r in longest_text(df, list(types), sample_rows, order).collect()}
    rules = {c: {"data_type": kind, "required": True, "check_corruption": True, "min_length": DEFAULT_MIN_LENGTH,
                 "max_length": int(lengths.get(c) or 0)} for c, kind in types.items()}
    return _configuration(rules, strategies)


def _configuration(rules: dict, strategies: dict | None) -> dict:
    return {"validation_rules": rules, "fix_strategies": strategies or {}, "custom_validation_rules": {
        "phone_formats": {"patterns": list(DEFAULT_PHONE_PATTERNS)},
        "url_validation": {"accepted_domains": list(DEFAULT_URL_DOMAINS)},
        "coordinate_validation": {"latitude_range": list(LATITUDE_RANGE), "longitude_range": list(LONGITUDE_RANGE)}}}
