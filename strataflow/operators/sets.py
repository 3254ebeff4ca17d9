"""Unions and schema differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

SCHEMA_ISSUE = T.StructType([T.StructField(n, T.StringType()) for n in
                             ("row_id", "column", "issue", "value", "masked_value")])


def union_all(frames) -> DataFrame:
    """Union by column name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def name_issues(df: DataFrame, column: str, expected) -> DataFrame:
    """``(column, issue)`` of expected names that no row has and of names in the rows that are not expected: one plan over the table."""
    found = df.select(F.col(column).alias("_found")).where(F.col("_found").isNotNull()).distinct()
    wanted = df.sparkSession.createDataFrame([(e,) for e in expected], "_wanted string")
    both = found.join(wanted, F.col("_found") == F.col("_wanted"), "full_outer").where(F.col("_found").isNull() | F.col("_wanted").isNull())
    return both.select(F.coalesce("_found", "_wanted").alias("column"),
                       F.when(F.col("_found").isNull(), "missing_column").otherwise("unexpected_column").alias("issue"))


def schema_issues(spark: SparkSession, actual, expected, missing: bool = True, unexpected: bool = True) -> DataFrame:
    """Missing and unexpected columns as issue rows (schema metadata only, no data is read)."""
    rows = []
    if missing:
        rows += [(None, c, "missing_column", None, None) for c in expected if c not in actual]
    if unexpected:
        rows += [(None, c, "unexpected_column", None, None) for c in actual if c not in expected]
    return spark.createDataFrame(rows, SCHEMA_ISSUE)
