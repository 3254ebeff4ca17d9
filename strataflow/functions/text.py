"""Text expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values.
SPECIAL_CHARACTERS = "!@#$%^&*()_+=[]{};:\"'<>,.?/~`"
SPECIAL_RATIO_LIMIT = 0.4
NON_PRINTABLE_ASCII = r"[^\x20-\x7E]"
REPORT_DATE_PATTERN = r"Attendance Date\s*[:\-]\s*(\d{2}-\w{3}-\d{4})"
HASH_SEPARATOR = "||"
NULL_MARK = "\u0000"
WHITESPACE = " \t\n\r\u000b\u000c"


def strip(c: Column) -> Column:
    """Remove blanks, tabs and line ends on both sides."""
    return F.trim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """Trim; empty text becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def full_name(*parts: Column) -> Column:
    """Space-joined parts, nulls skipped."""
    return F.concat_ws(" ", *parts)


def record_hash(columns, parity: bool = False) -> Column:
    """SHA-256 over the text of ``columns``.

    With ``parity=True`` nulls are skipped, so ``(a, null, b)`` and ``(a, b, null)`` share a hash; by
    default each null leaves a mark of its own.
    """
    texts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    if not parity:
        texts = [F.coalesce(t, F.lit(NULL_MARK)) for t in texts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *texts), 256)


def file_safe(c: Column) -> Column:
    """Every character but word characters, digits, ``-``, ``_`` and ``.`` becomes ``_``."""
    return F.regexp_replace(c, r"(?U)[^\w\-.]", "_")


def header_name(name: str) -> str:
    """Report header to column name: runs of dots and blanks to one underscore, none at the ends."""
    return re.sub(r"[\s._]+", "_", name.strip()).strip("_")


def report_date_text(c: Column) -> Column:
    """The ``dd-MMM-yyyy`` text of a report's date line, null if there is none."""
    return F.nullif(F.regexp_extract(c, REPORT_DATE_PATTERN, 1), F.lit(""))


def is_non_ascii(c: Column) -> Column:
    return c.rlike(NON_PRINTABLE_ASCII)


def special_count(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, SPECIAL_CHARACTERS, ""))


def is_mostly_special(c: Column) -> Column:
    """More than 40 % special characters."""
    return special_count(c) > F.length(c) * F.lit(SPECIAL_RATIO_LIMIT)


def matches_fully(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")


def matches_prefix(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})")


def labelled_value(text: Column, label: str, default: str | None = None) -> Column:
    """Value of the last ``LABEL: value`` line of a text, or ``default``.

    The text is trimmed first; inner colons stay in the value; an empty value is kept as ``''``.
    """
    prefix = f"{label}:"
    lines = F.split(strip(text), "\n")
    hits = F.filter(lines, lambda line: F.startswith(line, F.lit(prefix)))
    value = strip(F.substring(F.get(hits, F.size(hits) - 1), len(prefix) + 1, 2147483647))
    return F.coalesce(value, F.lit(default)) if default is not None else value


def run_label(run_id: Column, start: Column) -> Column:
    """``run_start``; empty text if either is missing."""
    return F.when(run_id.isNotNull() & start.isNotNull(), F.concat_ws("_", run_id, start)).otherwise(F.lit(""))


def one_line(c: Column) -> Column:
    """Line feeds to blanks, carriage returns removed."""
    return F.translate(c, "\n\r", " ")


def any_of(predicates) -> Column:
    return reduce(lambda a, b: a | b, predicates)
