"""Date and time expressions that turn bad input into null instead of failing the job."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from .casts import to_int, to_long

# Accepted input formats, tried in this order.
DATE_FORMATS = ("dd-MMM-yyyy", "yyyy-MM-dd")
TIMESTAMP_FORMATS = ("dd-MMM-yyyy hh:mm a", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss")
TIME_OF_DAY_FORMATS = ("yyyy-MM-dd HH:mm:ss", "HH:mm:ss", "dd-MMM-yyyy HH:mm:ss")
TEXT_STAMP_FORMAT = "dd-MMM-yyyy HH:mm:ss"

_TOKEN_SHAPES = {"MMM": "[A-Za-z]{3}", "yyyy": "[0-9]{4}", "a": "[AaPp][Mm]"}


def format_shape(fmt: str) -> str:
    """Regex of the text shape a datetime pattern accepts.

    Used as a guard: a failed parse costs an exception per row inside the JVM, while a
    regex test on the wrong shape is cheap.  In mixed-format columns every row
    fails all formats but one.
    """
    parts = []
    for token in re.findall(r"'[^']*'|y+|M+|d+|H+|h+|m+|s+|a+|.", fmt):
        if token.startswith("'"):
            parts.append(re.escape(token.strip("'")))
        elif token in _TOKEN_SHAPES:
            parts.append(_TOKEN_SHAPES[token])
        elif token[0].isalpha():
            parts.append(f"[0-9]{{{len(token)}}}")
        else:
            parts.append(re.escape(token))
    return "^" + "".join(parts) + "$"


def _guarded(text: Column, fmt: str, parsed: Column) -> Column:
    return F.when(text.rlike(format_shape(fmt)), parsed)


def parse_date(text: Column, formats=DATE_FORMATS) -> Column:
    """First format that parses wins; null if none does."""
    t = F.trim(text)
    return F.coalesce(*[_guarded(t, f, F.try_to_date(t, f)) for f in formats])


def parse_timestamp(text: Column, formats=TIMESTAMP_FORMATS) -> Column:
    t = F.trim(text)
    return F.coalesce(*[_guarded(t, f, F.try_to_timestamp(t, F.lit(f))) for f in formats])


def time_of_day(text: Column, formats=TIME_OF_DAY_FORMATS) -> Column:
    """Text of any accepted format reduced to ``HH:mm:ss``."""
    return F.date_format(parse_timestamp(text, formats), "HH:mm:ss")


def epoch_millis(text: Column) -> Column:
    """Epoch milliseconds held as text or number to a timestamp."""
    return F.timestamp_millis(to_long(text))


def epoch_or_text(text: Column, fmt: str = TEXT_STAMP_FORMAT) -> Column:
    """A column mixing one text format with epoch milliseconds."""
    t = F.trim(text)
    return F.when(t.rlike(format_shape(fmt)), F.try_to_timestamp(t, F.lit(fmt))).otherwise(epoch_millis(t))


def clock_to_minutes(text: Column) -> Column:
    """``HH:MM`` to whole minutes; null unless both parts are numbers."""
    parts = F.split(text, ":")
    hours, minutes = (to_int(F.get(parts, F.lit(i))) for i in (0, 1))
    return F.try_add(F.try_multiply(hours, F.lit(60)), minutes)


def millis_to_text(millis: Column) -> Column:
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd HH:mm:ss")


def duration_millis(start: Column, end: Column) -> Column:
    """``end - start``; 0 when either is missing or 0."""
    known = (F.coalesce(start, F.lit(0)) != 0) & (F.coalesce(end, F.lit(0)) != 0)
    return F.when(known, end - start).otherwise(F.lit(0).cast("bigint"))


def previous_day(date: Column, as_of: Column) -> Column:
    """True for rows dated the day before ``as_of``.

    The bare column is compared with a constant, so the predicate reaches the scan and prunes
    partitions of a date-partitioned table.
    """
    return date == F.date_sub(as_of, 1)
