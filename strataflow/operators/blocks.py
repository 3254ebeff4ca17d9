"""Ordered per-group computations that do not need the whole group in one task.

A window partitioned by group sends a group of any size to a single task.  These operators cut each group
into blocks of bounded size, summarise the blocks, run the ordered step over the few block summaries, and
finish inside each block.  ``block`` must grow with the order (for a dense integer order, ranges of it).

Rows are shuffled and sorted once, by (group, block); the window inside the block and the join that brings the block
summaries back both use that layout, and no join key holds more rows than a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DEFAULT_BLOCK_ROWS = 1 << 16


def integer_block(order: Column, size: int = DEFAULT_BLOCK_ROWS) -> Column:
    """Start of the range of ``size`` integers that holds the value."""
    return (order - F.pmod(order, F.lit(size))).cast("bigint")


def _group(keys) -> Column:
    """Group key that is never null, so that plain equality joins null keys and keeps the window's partitioning."""
    return F.struct(*keys) if keys else F.struct(F.lit(0))


def _attach(rows: DataFrame, summary: DataFrame) -> DataFrame:
    right = summary.withColumnsRenamed({"_group": "_r_group", "_block": "_r_block"})
    joined = rows.join(right, (F.col("_group") == F.col("_r_group")) & (F.col("_block") == F.col("_r_block")), "left")
    return joined.drop("_group", "_block", "_r_group", "_r_block")


def running_index(df: DataFrame, keys, order, block: Column, name: str, first: int = 1) -> DataFrame:
    """Exact ``row_number`` within ``keys`` by ``order`` (ascending), numbered from ``first``."""
    rows = df.withColumns({"_group": _group(keys), "_block": block})
    counts = rows.groupBy("_group", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    local = F.row_number().over(Window.partitionBy("_group", "_block").orderBy(*order))
    numbered = _attach(rows.withColumn("_local", local), offsets)
    value = F.col("_local") + F.col("_offset") + F.lit(first - 1)
    return numbered.withColumn(name, value.cast("bigint")).drop("_local", "_offset")


def row_index(df: DataFrame, order, block: Column, name: str = "row_index") -> DataFrame:
    """Global zero-based row number in a given total order."""
    return running_index(df, [], order, block, name, first=0)


def carry_forward(df: DataFrame, keys, order: str, block: Column, values: dict[str, Column],
                  firsts: dict[str, Column] | None = None) -> DataFrame:
    """Last non-null of each value up to and including the row, within ``keys`` by ``order``.

    ``firsts`` adds the first non-null value of the whole group, taken from the same block summaries.
    """
    firsts = firsts or {}
    rows = df.withColumns({"_group": _group(keys), "_block": block,
                           **{f"_v_{n}": v for n, v in {**values, **firsts}.items()}})

    def position(name):
        return F.when(F.col(f"_v_{name}").isNotNull(), F.col(order))

    summary = rows.groupBy("_group", "_block").agg(
        *[F.max_by(f"_v_{n}", position(n)).alias(f"_last_{n}") for n in values],
        *[F.min_by(f"_v_{n}", position(n)).alias(f"_first_{n}") for n in firsts])
    by_block = Window.partitionBy("_group").orderBy("_block")
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = summary.select(
        "_group", "_block",
        *[F.last(f"_last_{n}", ignorenulls=True).over(before).alias(f"_before_{n}") for n in values],
        *[F.first(f"_first_{n}", ignorenulls=True).over(everything).alias(n) for n in firsts])
    inside = Window.partitionBy("_group", "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"_here_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values}) \
        .drop(*[f"_v_{n}" for n in {**values, **firsts}])
    joined = _attach(local, summary)
    found = joined.withColumns({n: F.coalesce(f"_here_{n}", f"_before_{n}") for n in values})
    return found.drop(*[f"_here_{n}" for n in values], *[f"_before_{n}" for n in values])
