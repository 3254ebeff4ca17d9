"""Cell checks.  Any number of checks over any number of columns is one narrow pass over the table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions import pii
from ..functions.casts import to_long
from ..functions.semantic import fits_catalog_type
from ..functions.text import is_mostly_special, is_non_ascii, matches_fully, strip
from .sets import schema_issues, union_all

# Texts that count as null.
NULL_WORDS = ("null", "NULL", "None", "NONE", "nan", "NaN", "NAN")
ISSUE_COLUMNS = ("row_id", "column", "issue", "value", "masked_value")


@dataclass(frozen=True)
class CellCheck:
    """A predicate that marks a cell of ``column`` as having ``issue``."""
    column: str
    issue: str
    flagged: Column
    value: Column
    masked: Column | None = None


def _cell(name: str) -> Column:
    return F.col(f"`{name}`")


def cell_text(df: DataFrame, name: str) -> Column:
    """A cell as text; nested values as JSON."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(_cell(name))
    return _cell(name).cast("string")


def row_key(df: DataFrame, row_id: str | None) -> Column:
    """The caller's row key as text; without one, an id that is unique within this plan only."""
    return (F.col(row_id) if row_id else F.monotonically_increasing_id()).cast("string")


def dtype_checks(df: DataFrame, expected: dict[str, str]) -> list[CellCheck]:
    return [CellCheck(c, "dtype_mismatch", ~fits_catalog_type(c, df.schema[c].dataType, kind), cell_text(df, c))
            for c, kind in expected.items() if c in df.columns]


def null_checks(df: DataFrame, nullable: dict[str, bool]) -> list[CellCheck]:
    checks = []
    for field in df.schema.fields:
        if nullable.get(field.name, True):
            continue
        cell = _cell(field.name)
        flagged = cell.isNull()
        if isinstance(field.dataType, T.StringType):
            flagged = flagged | strip(cell).isin(*NULL_WORDS)
        checks.append(CellCheck(field.name, "null_violation", flagged, cell_text(df, field.name)))
    return checks


def corruption_checks(df: DataFrame, columns=None) -> list[CellCheck]:
    checks = []
    for c in columns if columns is not None else df.columns:
        text = cell_text(df, c)
        checks.append(CellCheck(c, "corrupted_non_ascii", is_non_ascii(text), text))
        checks.append(CellCheck(c, "corrupted_special_chars", is_mostly_special(text), text))
    return checks


def pattern_checks(df: DataFrame, patterns: dict[str, str]) -> list[CellCheck]:
    """Values must match their pattern in full; nulls are skipped."""
    return [CellCheck(c, "pattern_mismatch", ~matches_fully(cell_text(df, c), p), cell_text(df, c))
            for c, p in patterns.items() if c in df.columns]


def pii_checks(df: DataFrame, columns=None) -> list[CellCheck]:
    """Values that masking would change."""
    checks = []
    for c in columns if columns is not None else df.columns:
        text = cell_text(df, c)
        masked = pii.mask_pii(text)
        checks.append(CellCheck(c, "pii_detected", masked != text, text, masked))
    return checks


def find_issues(df: DataFrame, checks, row_id: str | None = None) -> DataFrame:
    """Issue rows ``(row_id, column, issue, value, masked_value)`` of all checks."""
    no_text = F.lit(None).cast("string")
    if not checks:
        return schema_issues(df.sparkSession, [], [])
    entries = [F.when(c.flagged, F.struct(F.lit(c.column).alias("column"), F.lit(c.issue).alias("issue"),
                                          c.value.alias("value"),
                                          (no_text if c.masked is None else c.masked).alias("masked_value")))
               for c in checks]
    return df.select(row_key(df, row_id).alias("row_id"), F.inline(F.array_compact(F.array(*entries))))


def first_issues(df: DataFrame, checks, row_id: str | None = None, n: int = 5) -> DataFrame:
    """The first ``n`` issue rows per column by row id: the sample shown in reports.

    The row id is text; numeric ids are ordered as numbers.  Every column is read by itself and a task holds its first ``n``
    rows, so no task sorts its issues; each check is evaluated once.
    """
    of_column: dict[str, list[CellCheck]] = {}
    for c in checks:
        of_column.setdefault(c.column, []).append(c)
    order = [to_long(F.col("row_id")).asc_nulls_last(), F.col("row_id"), F.col("issue")]
    return union_all([find_issues(df, own, row_id).orderBy(*order).limit(n) for own in of_column.values()] or [find_issues(df, [])])


def mask_table(df: DataFrame, columns=None) -> DataFrame:
    """Every chosen column as masked text."""
    chosen = set(columns if columns is not None else df.columns)
    return df.select([pii.mask_pii(cell_text(df, c)).alias(c) if c in chosen else _cell(c) for c in df.columns])


METADATA = "ARRAY<STRUCT<name: STRING, type_name: STRING, nullable: BOOLEAN, pii: BOOLEAN>>"


def parse_metadata(tables: DataFrame, metadata_col: str = "metadata") -> DataFrame:
    """Decode the JSON column list of each table row."""
    return tables.withColumn("columns", F.from_json(F.col(metadata_col), METADATA)).drop(metadata_col)


def metadata_rows(tables: DataFrame, *keep, metadata_col: str = "metadata") -> DataFrame:
    """One row per listed column.  The list is decoded inside the generator: in a projection before it, the filter that the
    optimizer puts there would decode it again."""
    return tables.select(*keep, F.inline(F.flatten(F.transform(F.array(metadata_col), lambda m: F.from_json(m, METADATA)))))


def rules_of_table(tables: DataFrame, table_id, id_col: str = "table_id") -> dict:
    """Expected schema, columns, nullability and PII columns of one table (one row, a handful of entries)."""
    row = parse_metadata(tables.filter(F.col(id_col) == F.lit(table_id))).first()
    if row is None:
        raise LookupError(f"no entry for table {table_id!r}")
    return rules_of_row(row)


def rules_of_row(row) -> dict:
    """The same from a row of decoded metadata (:func:`parse_metadata`)."""
    columns = row["columns"] or []
    return {"full_name": row.asDict().get("full_name"),
            "expected_schema": {c.name: c.type_name for c in columns},
            "expected_columns": [c.name for c in columns],
            "nullable": {c.name: True if c.nullable is None else c.nullable for c in columns},
            "pii_columns": [c.name for c in columns if c.pii]}


def tables_to_check(tables: DataFrame) -> DataFrame:
    """Tables changed since their last check, or never checked."""
    last = F.col("last_dq_checked")
    return tables.filter((F.col("updated_at") > last) | last.isNull())


def validate_table(df: DataFrame, rules: dict, row_id: str | None = None, patterns: dict[str, str] | None = None,
                   pii_columns=None) -> DataFrame:
    """All checks of one table: column set, types, nulls, corruption, patterns and personal data."""
    checks = (dtype_checks(df, rules["expected_schema"]) + null_checks(df, rules["nullable"])
              + corruption_checks(df) + pattern_checks(df, patterns or {}) + pii_checks(df, pii_columns))
    table_level = schema_issues(df.sparkSession, df.columns, rules["expected_columns"])
    return union_all([find_issues(df, checks, row_id), table_level])


def tag_table(issues: DataFrame, table_id) -> DataFrame:
    """Issue rows with their table id as the first column."""
    return issues.select(F.lit(table_id).alias("table_id"), "*")
