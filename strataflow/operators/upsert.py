"""Idempotent merges expressed on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def delete_insert(target: DataFrame, batch: DataFrame, date_col: str) -> DataFrame:
    """Replace the batch's dates: target rows of other dates plus the whole batch."""
    dates = batch.select(F.col(date_col).alias("_batch_date")).distinct()
    kept = target.join(dates, F.col(date_col) == F.col("_batch_date"), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def absent(batch: DataFrame, existing: DataFrame, key: str, narrow_batch: bool = False) -> DataFrame:
    """Batch rows whose key the existing table lacks.

    With ``narrow_batch`` the existing keys are first reduced to those of the batch.  A batch small enough for a
    broadcast then spares the shuffle of the existing table's keys.
    """
    keys = existing.select(F.col(key).alias("_key"))
    if narrow_batch:
        wanted = batch.select(F.col(key).alias("_wanted")).distinct()
        keys = keys.join(wanted, F.col("_key") == F.col("_wanted"), "left_semi")
    return batch.join(keys, F.col(key) == F.col("_key"), "left_anti")


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Target plus the batch rows whose key it lacks; existing rows are never updated."""
    return target.unionByName(absent(batch, target, key), allowMissingColumns=True)


def within_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in another table."""
    wanted = keys.select(F.col(key).alias("_wanted")).distinct()
    return df.join(wanted, F.col(key) == F.col("_wanted"), "left_semi")


def stamp_checked(tables: DataFrame, checked: DataFrame, now_epoch, key: str = "table_id",
                  stamp: str = "last_dq_checked") -> DataFrame:
    """Set the check time of every table listed in ``checked``."""
    hits = checked.select(F.col(key).alias("_checked")).distinct()
    joined = tables.join(hits, F.col(key) == F.col("_checked"), "left")
    value = F.when(F.col("_checked").isNotNull(), F.lit(now_epoch).cast("bigint")).otherwise(F.col(stamp))
    return joined.withColumn(stamp, value).drop("_checked")
