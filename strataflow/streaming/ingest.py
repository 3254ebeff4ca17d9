"""New files to bronze, new bronze rows to silver and gold."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import keep_latest
from ..operators.layout import scratch, stage
from ..operators.sets import union_all
from ..session import stream_checkpoint
from ..plans.intake import BRONZE_LINE
from ..sources.lake import BATCH, Lake


def raw_line_stream(spark: SparkSession, folder: str, suffix: str = ".jsonl", archive: str | None = None,
                    max_files: int | None = None) -> DataFrame:
    """Lines of files as they arrive.  With ``archive`` processed files are moved there (one batch later)."""
    reader = spark.readStream.option("pathGlobFilter", f"*{suffix}")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder).select(F.col("value").alias("raw_json"))


def ingest_to_bronze(lake: Lake, folder: str, name: str, checkpoint: str | None = None, **source) -> StreamingQuery:
    """Add every new file once and stop.

    Micro-batches go through the bronze writer of batch runs, as partitions named by stream and batch: a batch handed over
    again replaces itself, and runs of either kind can share a table.
    """
    lines = raw_line_stream(lake.spark, folder, **source)
    where = stream_checkpoint(lake.spark, f"ingest_{name}", checkpoint)
    stream = hashlib.sha256(where.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        lake.write_bronze(batch, name, align=False, batch=f"stream-{stream}-{batch_id}")

    return lines.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", where).start()


def bronze_stream(lake: Lake, name: str) -> DataFrame:
    layout = T.StructType(BRONZE_LINE.fields + [T.StructField(BATCH, T.StringType())])
    return lake.spark.readStream.schema(layout).parquet(lake.path(name)).select(*BRONZE_LINE.names)


def latest_into_partitions(lake: Lake, batch: DataFrame, name: str, keys, order, date_col: str) -> DataFrame:
    """Merge a batch into a date-partitioned table that holds one row per key.

    Read and replaced are the partitions of the batch's dates and of the dates at which its keys stand in the table (found
    from the key and date columns alone), so a key whose date has moved leaves no row behind.  Merging the same batch twice
    gives the same table.  Returns the dates replaced.
    """
    dates = batch.select(F.col(date_col).alias("_batch_date"))
    if not lake.exists(name):
        lake.replace_partitions(batch, name, date_col)
        return dates.distinct()
    moved = batch.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    before = lake.read(name).select(*keys, F.col(date_col).alias("_batch_date")).join(moved, same, "left_semi").select("_batch_date")
    # Stored: the table changes below.
    dates = stage(dates.union(before).distinct(), "batch-dates")
    known = lake.read(name).join(dates, F.col(date_col).eqNullSafe(F.col("_batch_date")), "left_semi")
    merged = stage(keep_latest(union_all([known, batch]), keys, order), "merged")
    lake.replace_partitions(merged, name, date_col, dates)
    return dates


def upsert_stream(stream: DataFrame, apply: Callable[[DataFrame, int], None], name: str,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Run ``apply(batch, batch_id)`` for each new batch and stop when caught up.

    ``apply`` must be repeatable: a batch interrupted after its writes is handed over again.
    """
    return (stream.writeStream.foreachBatch(apply).trigger(availableNow=True)
            .option("checkpointLocation", stream_checkpoint(stream.sparkSession, f"upsert_{name}", checkpoint))
            .start())


def upsert_facts(lake: Lake, bronze: str, silver: str, transform: Callable[[DataFrame], DataFrame], keys, date_col: str,
                 gold: str | None = None, to_gold: Callable[[DataFrame], DataFrame] | None = None,
                 checkpoint: str | None = None, order: str = "ingest_timestamp") -> StreamingQuery:
    """Keep silver (one row per key) and optionally gold up to date with each batch of bronze rows.

    ``transform`` turns bronze rows into silver rows that still carry the ``order`` column.  Gold is rebuilt for the
    batch's dates from the merged silver partitions.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        with scratch(lake.spark):
            rows = stage(transform(batch), "batch-rows")
            dates = latest_into_partitions(lake, rows, silver, keys, [order], date_col)
            if gold and to_gold:
                touched = lake.read(silver).join(dates, F.col(date_col).eqNullSafe(F.col("_batch_date")), "left_semi")
                lake.replace_partitions(to_gold(touched), gold, date_col, dates)

    return upsert_stream(bronze_stream(lake, bronze), apply, silver, checkpoint)


def upsert_dimension(lake: Lake, bronze: str, dimension: str, transform: Callable[[DataFrame], DataFrame], key: str,
                     surrogate: str | None = None, as_of: Column | None = None,
                     checkpoint: str | None = None) -> StreamingQuery:
    """Apply each batch of bronze rows to a type-2 dimension."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        lake.apply_scd(transform(batch), dimension, key, as_of, surrogate=surrogate)

    return upsert_stream(bronze_stream(lake, bronze), apply, dimension, checkpoint)
