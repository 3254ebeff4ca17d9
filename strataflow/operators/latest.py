"""Latest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T


def _tie_break(df: DataFrame) -> Column:
    """Hash of the whole row, so that equal order values still give one repeatable winner."""
    parts = [F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`")
             for f in df.schema.fields]
    return F.xxhash64(*parts)


def keep_latest(df: DataFrame, keys, order, tie_break: bool = True) -> DataFrame:
    """One row per ``keys``: the one with the highest ``order`` values.

    ``row_number() = 1`` makes Catalyst put a WindowGroupLimit before the shuffle, so each task sends
    at most one row per key and a key holding a third of the table costs no more than any other.
    ``order`` holds column names (descending, nulls last) or ready sort Columns.
    """
    sort = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    if tie_break:
        sort.append(_tie_break(df).desc())
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_with_count(df: DataFrame, keys, order, carry, counted: Column, count_name: str) -> DataFrame:
    """Latest row per key plus a count over all rows of the key, in one aggregation.

    Both parts combine on the map side; a window over the key would move every row of a hot key to one task.
    A null in the first order column ranks highest, as in a descending sort that puts nulls first.
    """
    first, *rest = order
    rank = F.struct(F.col(first).isNull().alias("missing"), F.col(first), *[F.col(o) for o in rest])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*carry), rank).alias("_row"),
                                   F.count(counted).alias(count_name))
    return picked.select(*keys, "_row.*", count_name)
