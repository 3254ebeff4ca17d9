"""JSON payload expressions: find the payload in a line, decode any of its shapes, explode once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Where each feed keeps its payload, first hit wins.
WRAPPED_RESULT = "$._airbyte_data.response.result"
PLAIN_RESULT = "$.response.result"
ROOT_RESULT = "$.result"
WRAPPER = "$._airbyte_data"
WRAPPER_ID = "$._airbyte_ab_id"
ATTENDANCE_PATHS = (WRAPPED_RESULT, WRAPPER)
LEAVE_PATHS = (WRAPPED_RESULT, PLAIN_RESULT, ROOT_RESULT, WRAPPER)
TIMESHEET_PATHS = (WRAPPED_RESULT, PLAIN_RESULT, ROOT_RESULT)
EMPLOYEE_PATHS = (WRAPPED_RESULT, PLAIN_RESULT, ROOT_RESULT, WRAPPER)
# Entries of a record map that are not records.
BOOKKEEPING_KEYS = ("status", "message", "total_count")


def locate(line: Column, paths, or_whole_line: bool = False) -> Column:
    """First non-null of several JSON paths, optionally falling back to the line itself."""
    hits = [F.get_json_object(line, p) for p in paths]
    return F.coalesce(*hits, line) if or_whole_line else F.coalesce(*hits)


def explode_structs(df: DataFrame, payload: Column, record_ddl: str, *keep, alias: str = "record") -> DataFrame:
    """One row per element of a JSON array of objects (a single object counts as one element)."""
    decoded = F.from_json(payload, f"ARRAY<{record_ddl}>")
    return df.select(*keep, F.explode(decoded).alias(alias)).filter(F.col(alias).isNotNull())


def explode_texts(df: DataFrame, payload: Column, *keep, alias: str = "record_json") -> DataFrame:
    """One row per element of a JSON array, each element kept as JSON text."""
    return df.select(*keep, F.explode(F.from_json(payload, "ARRAY<STRING>")).alias(alias)) \
        .filter(F.col(alias).isNotNull())


def explode_map(df: DataFrame, payload: Column, *keep, key: str = "record_id", value: str = "record_json",
                exclude=BOOKKEEPING_KEYS) -> DataFrame:
    """One row per entry of a JSON object, bookkeeping entries left out."""
    rows = df.select(*keep, F.explode(F.from_json(payload, "MAP<STRING,STRING>")).alias(key, value))
    return rows.filter(~F.col(key).isin(*exclude)) if exclude else rows


def explode_records(df: DataFrame, texts: Column, record_ddl: str, *keep, alias: str = "record") -> DataFrame:
    """One row per record text, decoded.

    Decoding happens inside the generator, so filters on decoded fields stop there.  Decoding in a later
    projection would let the optimizer push such a filter below it together with a copy of the JSON parse for every
    mention of a field.
    """
    decoded = F.transform(texts, lambda x: F.from_json(x, record_ddl))
    return df.select(*keep, F.explode(decoded).alias(alias)).filter(F.col(alias).isNotNull())


def explode_map_records(df: DataFrame, payload: Column, record_ddl: str, *keep, key: str = "record_id",
                        alias: str = "record", exclude=BOOKKEEPING_KEYS) -> DataFrame:
    """One row per entry of a JSON object of records: key and decoded record, bookkeeping entries left out."""
    entries = F.map_entries(F.from_json(payload, "MAP<STRING,STRING>"))
    records = F.filter(entries, lambda e: ~e["key"].isin(*exclude)) if exclude else entries
    decoded = F.transform(records, lambda e: F.struct(e["key"].alias(key), F.from_json(e["value"], record_ddl).alias(alias)))
    return df.select(*keep, F.inline(decoded)).filter(F.col(alias).isNotNull())


def first_json_element(text: Column) -> Column:
    return F.get(F.from_json(text, "ARRAY<STRING>"), F.lit(0))


def first_map_value(m: Column) -> Column:
    return F.get(F.map_values(m), F.lit(0))


def record_texts(payload: Column, id_field: str) -> Column:
    """Any payload shape to ``ARRAY<STRING>`` of record texts.

    Handles a single record, an array of records, an array of maps of records, and a map of
    records; an entry that is itself an array gives its first element.  One expression and one explode
    over one scan; malformed payloads give no record.
    """
    # Binding the payload to a lambda variable keeps it from being located anew at each mention.
    return F.flatten(F.transform(F.array(payload), lambda p: F.coalesce(
        _record_texts(p, id_field), F.array().cast("array<string>"))))


def _record_texts(payload: Column, id_field: str) -> Column:
    id_path = f"$.{id_field}"
    no_texts = F.array().cast("array<string>")

    def is_record(x: Column) -> Column:
        return F.get_json_object(x, id_path).isNotNull()

    def entries(x: Column) -> Column:
        return F.map_values(F.from_json(x, "MAP<STRING,STRING>"))

    from_array = F.flatten(F.transform(
        F.from_json(payload, "ARRAY<STRING>"),
        lambda e: F.when(is_record(e), F.array(e)).otherwise(F.coalesce(entries(e), no_texts))))
    shaped = (F.when(is_record(payload), F.array(payload))
              .when(F.startswith(payload, F.lit("[")), from_array)
              .when(F.startswith(payload, F.lit("{")), entries(payload)))
    return F.transform(shaped, lambda x: F.when(F.startswith(x, F.lit("[")), first_json_element(x)).otherwise(x))


def struct_ddl(fields, type_name: str = "STRING") -> str:
    """DDL of a struct whose fields share one type."""
    return "STRUCT<" + ", ".join(f"`{f}`: {type_name}" for f in fields) + ">"


def renamed(prefix: str, mapping: dict[str, str]) -> list[Column]:
    """Select list ``prefix.source AS target`` from a source-to-target mapping."""
    head = f"{prefix}." if prefix else ""
    return [F.col(f"{head}`{source}`").alias(target) for source, target in mapping.items()]
