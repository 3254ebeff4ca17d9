"""Taking raw line files into bronze."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..operators.layout import stage
from ..sources.files import RAW_LINE, archive_files, list_files, read_files
from ..sources.lake import BATCH, Lake

BRONZE_LINE = T.StructType(RAW_LINE.fields + [T.StructField("ingest_timestamp", T.TimestampType())])


#: Files taken into bronze: a file is another one when its time or size has changed.
FILES_TAKEN = T.StructType([T.StructField("path", T.StringType()), T.StructField("modified", T.TimestampType()), T.StructField("bytes", T.LongType()),
                            T.StructField(BATCH, T.StringType())])


def take_in_once(lake: Lake, folder: str, bronze: str, as_of: Column | None = None, exclude: str | None = None,
                 suffix: str = ".jsonl") -> list[str]:
    """As :func:`take_in`, but files taken before are left out, without moving them away; changed files are taken again.

    New files are entered in the ledger ``<bronze>_files`` under a batch name before they are read.  A batch without a bronze partition
    was interrupted: its files are read again, under the same name.
    """
    ledger = f"{bronze}_files"
    listed = list_files(lake.spark, folder, suffix, exclude).select("path", "modified", "bytes")
    known = lake.read_or_empty(ledger, FILES_TAKEN)
    before = known.select(F.col("path").alias("_path"), F.col("modified").alias("_modified"), F.col("bytes").alias("_bytes"))
    same = (F.col("path") == F.col("_path")) & (F.col("modified") == F.col("_modified")) & (F.col("bytes") == F.col("_bytes"))
    fresh = stage(listed.join(before, same, "left_anti").withColumn(BATCH, F.lit(f"files-{uuid.uuid4().hex}")), "new-files")
    if not fresh.isEmpty():
        lake.append(fresh.coalesce(1), ledger, align=False)
    written = lake.partition_values(bronze, BATCH) if lake.exists(bronze) else []
    open_ = lake.read_or_empty(ledger, FILES_TAKEN).where(F.lit(True) if not written else ~F.col(BATCH).isin(written))
    taken = []
    # Most often one batch: all files that are new since the last run.
    for batch in [r[0] for r in open_.select(BATCH).distinct().orderBy(BATCH).collect()]:
        paths = [r.path for r in open_.where(F.col(BATCH) == batch).select("path").collect()]
        lake.write_bronze(read_files(lake.spark, paths).select(F.col("value").alias("raw_json")), bronze, as_of, align=False, batch=batch)
        taken += paths
    return taken


def take_in(lake: Lake, folder: str, bronze: str, as_of: Column | None = None, exclude: str | None = None,
            suffix: str = ".jsonl", once: bool = False) -> list[str]:
    """Append the lines of the folder's files to bronze; returns the files taken, none if there were none.

    Exactly the listed files are read, so a file that arrives meanwhile waits for the next run.  With ``once`` a ledger tells which files
    were taken before.
    """
    if once:
        return take_in_once(lake, folder, bronze, as_of, exclude, suffix)
    paths = [r.path for r in list_files(lake.spark, folder, suffix, exclude).select("path").collect()]
    lines = read_files(lake.spark, paths)
    if lines is not None:
        lake.write_bronze(lines.select(F.col("value").alias("raw_json")), bronze, as_of, align=False)
    return paths


def bronze_lines(lake: Lake, bronze: str) -> DataFrame:
    return lake.read(bronze, BRONZE_LINE).select(*BRONZE_LINE.names)


def archive(lake: Lake, paths, folder: str, target: str | None) -> None:
    """Move the files of a finished run away, if a target is given."""
    if target:
        archive_files(lake.spark, paths, folder, target)
