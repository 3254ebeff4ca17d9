"""Casts that yield null on bad input, whatever the session's ANSI setting.

Each cast is guarded by the shape of the text.  A failing ``try_cast`` costs the JVM an exception per row, about twenty
microseconds; a regex that finds the wrong shape costs a fraction of one.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_PAD = r"[\x00-\x20]*"
INTEGER_SHAPE = rf"^{_PAD}[+-]?[0-9]+{_PAD}$"
NUMBER_SHAPE = rf"^{_PAD}[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?{_PAD}$"
FLOAT_WORDS = r"(?i)^[\s]*[+-]?(?:nan|inf|infinity)[\s]*$"


def _guarded(c: Column, shape: str, kind: str) -> Column:
    text = c.cast("string")
    return F.when(text.rlike(shape), text.try_cast(kind))


def to_long(c: Column) -> Column:
    return _guarded(c, INTEGER_SHAPE, "bigint")


def to_int(c: Column) -> Column:
    return _guarded(c, INTEGER_SHAPE, "int")


def to_tiny(c: Column) -> Column:
    return _guarded(c, INTEGER_SHAPE, "tinyint")


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    return _guarded(c, NUMBER_SHAPE, f"decimal({precision},{scale})")


def to_double(c: Column) -> Column:
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_SHAPE) | text.rlike(FLOAT_WORDS), text.try_cast("double"))


def to_flag(c: Column) -> Column:
    """0/1 flag from a number or a boolean word (JSON ``true`` arrives as text)."""
    return F.coalesce(to_tiny(c), c.cast("string").try_cast("boolean").cast("tinyint"))


def join_key(c: Column) -> Column:
    """Keys are compared as text so that a number never meets an alphanumeric id."""
    return c.cast("string")
