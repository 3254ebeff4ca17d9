"""Projection, filtering and clean-up of raw columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.casts import to_int
from ..functions.text import blank_to_null, header_name


def rename_select(df: DataFrame, mapping: dict[str, str], *extra) -> DataFrame:
    """Keep and rename exactly the mapped columns."""
    return df.select(*extra, *[F.col(f"`{source}`").alias(target) for source, target in mapping.items()])


def blank_strings_to_null(df: DataFrame, columns=None) -> DataFrame:
    """Trim text columns and turn empty text into null; other types pass through unchanged."""
    chosen = set(columns if columns is not None else df.columns)
    return df.select([
        blank_to_null(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in chosen and isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows lacking any of the key columns."""
    return df.dropna(how="any", subset=list(columns))


def sanitise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[header_name(c) for c in df.columns])


def resolve_alias(df: DataFrame, *names: str) -> Column:
    """First non-null among the columns whose name matches one of ``names``, ignoring case."""
    wanted = {n.lower() for n in names}
    found = [F.col(f"`{c}`") for c in df.columns if c.lower() in wanted]
    if not found:
        raise ValueError(f"none of {sorted(wanted)} among the columns {df.columns}")
    return F.coalesce(*found)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def keep_existing(df: DataFrame, wanted) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select([F.col(f"`{c}`") for c in wanted if c in df.columns])


def first_existing(df: DataFrame, *names: str) -> Column:
    """Column by its first name that exists."""
    for name in names:
        if name in df.columns:
            return F.col(f"`{name}`")
    raise ValueError(f"none of {names} among the columns {df.columns}")


def in_batch_dates(df: DataFrame, batch: DataFrame, date_col: str, batch_date_col: str | None = None) -> DataFrame:
    """Rows dated on one of the batch's dates, plus undated rows.

    One semi join with a null-safe key: the batch's distinct dates get one null entry, so undated rows need no
    second pass.  The bare date column stays on both sides, which keeps dynamic partition pruning possible.
    """
    source = batch_date_col or date_col
    dates = batch.select(F.col(source).alias("_batch_date")).distinct()
    undated = batch.sparkSession.range(1).select(F.lit(None).cast(batch.schema[source].dataType).alias("_batch_date"))
    dates = dates.unionByName(undated).distinct()
    return df.join(dates, F.col(date_col).eqNullSafe(F.col("_batch_date")), "left_semi")


def add_constants(df: DataFrame, constants: dict[str, object], typed_nulls: dict[str, str] | None = None) -> DataFrame:
    columns = {name: F.lit(value) for name, value in constants.items()}
    columns.update({name: F.lit(None).cast(kind) for name, kind in (typed_nulls or {}).items()})
    return df.withColumns(columns)


def hours_and_overtime(df: DataFrame, hours_col: str, limit: int = 8) -> DataFrame:
    """Whole hours from text and a flag for more than ``limit`` of them."""
    hours = to_int(F.col(hours_col))
    return df.withColumn("hours_worked", hours).withColumn("is_overtime", hours > F.lit(limit))
