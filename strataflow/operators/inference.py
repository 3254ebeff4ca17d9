"""Types of columns from their values: one scan, whatever the number of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .metrics import cell_text

#: Candidate types from narrow to wide with the shape of their texts; what fits none of them is a string.
SHAPES = (
    ("boolean", r"^(?:true|false|TRUE|FALSE)$"),
    ("int", r"^[+-]?[0-9]{1,9}$"),
    ("bigint", r"^[+-]?[0-9]{1,18}$"),
    ("double", r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]{1,2})?$"),
    ("date", r"^[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])$"),
    ("timestamp", r"^[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?:[ T](?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\.[0-9]{1,6})?)?$"),
)
WIDEST = "string"


def _narrowest(present: Column, fitting: list[Column]) -> Column:
    """The first candidate that every value fits; a column without values is a string."""
    kind = F.when(present == 0, WIDEST)
    for (name, _), count in zip(SHAPES, fitting):
        kind = kind.when(count == present, name)
    return kind.otherwise(WIDEST)


def infer_types(df: DataFrame, columns=None) -> DataFrame:
    """``(column, data_type, rows, present, max_length)``, one row per column.

    A value counts for every candidate type its text fits, so the counts of all candidates come from one aggregation with partial sums, and
    the narrowest type that fits all values is chosen from them inside the plan.  Nulls fit every type.
    """
    names = list(columns if columns is not None else df.columns)
    texts = df.select(*[cell_text(df, c).alias(f"t{i}") for i, c in enumerate(names)])
    counts = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(names)):
        counts += [F.count(f"t{i}").alias(f"n{i}"), F.max(F.length(f"t{i}")).alias(f"m{i}")]
        counts += [F.count_if(F.col(f"t{i}").rlike(shape)).alias(f"k{i}_{name}") for name, shape in SHAPES]
    wide = texts.agg(*counts)
    return wide.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column"), _narrowest(F.col(f"n{i}"), [F.col(f"k{i}_{name}") for name, _ in SHAPES]).alias("data_type"), F.col("rows"),
        F.col(f"n{i}").alias("present"), F.col(f"m{i}").cast("bigint").alias("max_length")) for i, c in enumerate(names)])))
