"""Predicates that say whether a value fits a named type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from .casts import to_double
from .temporal import DATE_FORMATS, parse_date
from .text import any_of, matches_fully, strip

# Catalog type families, and the words and patterns of semantic types.
INTEGER_TYPES = ("int", "integer", "tinyint", "smallint", "bigint")
FLOAT_TYPES = ("float", "real", "double", "decimal")
CATALOG_BOOLEAN_WORDS = ("true", "false", "0", "1")
SEMANTIC_BOOLEAN_WORDS = ("true", "false", "1", "0", "yes", "no")
EMAIL_PATTERN = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
LATLONG_PATTERN = r"(-?\d+(?:\.\d+)?)\s*,\s*(-?\d+(?:\.\d+)?)"
URL_SCHEMES = ("http://", "https://")
LATITUDE_RANGE = (-90, 90)
LONGITUDE_RANGE = (-180, 180)

INTEGER_TEXT = r"\s*[+-]?\d+\s*"
FLOAT_TEXT = r"(?i)\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|inf|infinity)\s*"


def _is_integer_text(text: Column) -> Column:
    return matches_fully(text, INTEGER_TEXT)


def _is_float_text(text: Column) -> Column:
    """Text a float can be read from.

    A regex instead of a cast: the JVM also accepts suffixes such as ``1.5f``.
    """
    return matches_fully(text, FLOAT_TEXT)


def fits_catalog_type(name: str, data_type: T.DataType, catalog_type: str) -> Column:
    """Does each value of column ``name`` fit the catalog type?  Null and unknown types always fit."""
    wanted = catalog_type.lower()
    value = F.col(f"`{name}`")
    family = wanted.split("<")[0].split("(")[0]
    if family in ("array", "map", "struct", "binary"):
        kinds = {"array": T.ArrayType, "map": (T.MapType, T.StructType), "struct": (T.MapType, T.StructType),
                 "binary": T.BinaryType}
        return value.isNull() | F.lit(isinstance(data_type, kinds[family]))
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return value.isNull() | F.lit(wanted not in INTEGER_TYPES + FLOAT_TYPES + ("boolean",))
    text = value.cast("string")
    if wanted in INTEGER_TYPES:
        if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
            # A number truncates to an integer unless it is not finite.
            fits = text.isin("NaN", "Infinity", "-Infinity") == F.lit(False)
        elif isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            fits = F.lit(False)
        elif isinstance(data_type, T.StringType):
            fits = _is_integer_text(text)
        else:
            fits = F.lit(True)
    elif wanted in FLOAT_TYPES:
        if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            fits = F.lit(False)
        else:
            fits = _is_float_text(text) if isinstance(data_type, T.StringType) else F.lit(True)
    elif wanted == "boolean":
        fits = F.lower(text).isin(*CATALOG_BOOLEAN_WORDS)
    else:
        fits = F.lit(True)
    return value.isNull() | fits


def _phone(text: Column, patterns=None) -> Column:
    t = strip(text)
    clean = ~t.rlike(r"[^0-9\s+\-()]")
    if patterns is not None:
        return clean & any_of([matches_fully(t, p) for p in patterns]) if patterns else F.lit(False)
    digits = F.length(F.regexp_replace(t, r"[^0-9]", ""))
    return clean & digits.between(10, 15)


def _url(text: Column, domains=None) -> Column:
    tests = [F.startswith(text, F.lit(s)) for s in URL_SCHEMES]
    return any_of(tests + [F.contains(text, F.lit(d)) for d in (domains or [])])


def _latlong(text: Column, rules=None) -> Column:
    shape = matches_fully(text, LATLONG_PATTERN)
    if rules is None:
        return shape
    bounds = (rules.get("latitude_range", LATITUDE_RANGE), rules.get("longitude_range", LONGITUDE_RANGE))
    # Nested WHEN: the numbers are only extracted once the shape is known to fit.
    parts = [to_double(F.regexp_extract(text, rf"\A{LATLONG_PATTERN}\z", i + 1)) for i in (0, 1)]
    inside = [p.between(*b) for p, b in zip(parts, bounds)]
    return F.when(shape, inside[0] & inside[1]).otherwise(F.lit(False))


def fits_semantic_type(value: Column, kind: str, custom: dict | None = None) -> Column:
    """Does a (non-null) value fit one of the nine semantic types?  Null never fits, unknown types always do."""
    custom = custom or {}
    text = value.cast("string")
    if kind == "integer":
        fits = matches_fully(text, r"-?[0-9]+")
    elif kind == "float":
        fits = _is_float_text(text)
    elif kind == "boolean":
        fits = F.lower(text).isin(*SEMANTIC_BOOLEAN_WORDS)
    elif kind == "date":
        fits = F.coalesce(parse_date(text, DATE_FORMATS).cast("timestamp"), text.try_cast("timestamp")).isNotNull()
    elif kind == "email":
        fits = matches_fully(text, EMAIL_PATTERN)
    elif kind == "phone":
        rules = custom.get("phone_formats")
        fits = _phone(text, None if rules is None else rules.get("patterns", []))
    elif kind == "url":
        fits = _url(text, custom.get("url_validation", {}).get("accepted_domains"))
    elif kind == "latlong":
        fits = _latlong(text, custom.get("coordinate_validation"))
    else:
        fits = F.lit(True)
    return value.isNotNull() & fits
