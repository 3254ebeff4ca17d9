"""File sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.cleaning import drop_empty_rows
from ..operators.sets import union_all

RAW_LINE = T.StructType([T.StructField("raw_json", T.StringType())])
FAILED_MARK = "_failed_parse"


def list_files(spark: SparkSession, folder: str, suffix: str = "", exclude: str | None = None,
               ignore_case: bool = False) -> DataFrame:
    """Files below a folder as ``(path, modified, bytes)``.  Only the listing is read, never the contents; empty files are left out."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes")))
    name = F.element_at(F.split("path", "/"), -1)
    if suffix:
        tail = F.lower(name) if ignore_case else name
        files = files.filter(F.endswith(tail, F.lit(suffix.lower() if ignore_case else suffix)))
    if exclude:
        files = files.filter(~F.contains(name, F.lit(exclude)))
    return files


def read_files(spark: SparkSession, paths, file_type: str = "text", schema=None, **options) -> DataFrame | None:
    """Text or JSON lines of a list of paths or globs; ``None`` for an empty list.

    Executors read the paths themselves.  A JSON schema should be given; without one Spark scans the data twice.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return None
    reader = spark.read.options(**options)
    if file_type == "text":
        return reader.text(paths)
    if file_type == "json":
        reader = reader.option("multiLine", options.get("multiline", "false"))
        return (reader.schema(schema) if schema is not None else reader).json(paths)
    raise ValueError(f"unsupported file type {file_type!r}")


def read_raw_lines(spark: SparkSession, folder: str, suffix: str = ".jsonl", exclude: str | None = None) -> DataFrame:
    """Each line of the matching files as ``raw_json``."""
    lines = spark.read.option("pathGlobFilter", f"*{suffix}").text(folder)
    if exclude:
        lines = lines.filter(~F.contains(F.col("_metadata.file_name"), F.lit(exclude)))
    return lines.select(F.col("value").alias("raw_json"))


def archive_files(spark: SparkSession, paths, source_folder: str, target_folder: str) -> list[str]:
    """Move processed files from one folder to another, replacing older copies; returns the new paths.

    Renames only: no data passes through the driver.  For an endless flow of files use the stream of
    :mod:`strataflow.streaming.ingest`, which archives by itself.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    moved = []
    for path in paths:
        source, target = hadoop(path), hadoop(path.replace(source_folder.rstrip("/"), target_folder.rstrip("/"), 1))
        fs = source.getFileSystem(conf)
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(source, target):
            raise OSError(f"could not archive {path}")
        moved.append(target.toString())
    return moved


def read_csv(spark: SparkSession, path, schema=None, skip_malformed: bool = False) -> DataFrame:
    """CSV with a header.  Pass a schema for large inputs: inferring types reads the files an extra time."""
    reader = spark.read.option("header", "true").option("mode", "DROPMALFORMED" if skip_malformed else "PERMISSIVE")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(path)


def read_rule_input(spark: SparkSession, path, schema=None) -> DataFrame:
    """CSV for rule checks: malformed lines skipped, rows without any value dropped."""
    return drop_empty_rows(read_csv(spark, path, schema, skip_malformed=True))


def _sheet_lines(spark: SparkSession, paths, header_rows: int) -> DataFrame:
    """``(path, value, heading)`` of all lines of all extracts in one scan; the first ``header_rows`` + 1 of a file are headings.

    Lines of one split are numbered in order, so a heading is one of the first numbers of a file's first split; where that
    split's numbers begin is one row per file.
    """
    lines = spark.read.text(list(paths)).select(
        "value", F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"))
    begins = lines.where("start = 0").groupBy("path").agg(F.min("at").alias("begin")).withColumnRenamed("path", "_path")
    joined = lines.join(begins, F.col("path") == F.col("_path"), "left")
    return joined.select("path", "value", ((F.col("start") == 0) & (F.col("at") - F.col("begin") <= header_rows)).alias("heading"))


def sheet_name(path: Column) -> Column:
    """File name without folder and extension."""
    return F.url_decode(F.replace(F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1), F.lit("+"), F.lit("%2B")))


def read_sheets(spark: SparkSession, paths, columns, header_rows: int = 9, tag: str = "SourceSheet",
                dates: Callable[[Column], Column] | None = None) -> DataFrame:
    """Report extracts (one CSV text per sheet) in one scan, each row tagged with its sheet.

    ``paths``: files or folders.  The first ``header_rows`` lines of an extract are headings and the next one names the columns.
    ``columns`` are the column names in file order, already cleaned.  ``dates`` finds the report's date in a heading line;
    with it, rows get their file's first date as ``report_date``.
    """
    ddl = ", ".join(f"`{c}` STRING" for c in columns)
    lines = _sheet_lines(spark, [paths] if isinstance(paths, str) else paths, header_rows)
    rows = lines.where(~F.col("heading")).select("path", F.from_csv("value", F.lit(ddl)).alias("r"))
    body = rows.select("path", "r.*", sheet_name(F.col("path")).alias(tag))
    if dates is None:
        return body.drop("path")
    found = lines.where("heading").select(F.col("path").alias("_path"), dates(F.col("value")).alias("report_date"))
    first = found.groupBy("_path").agg(F.min("report_date").alias("report_date"))
    return body.join(first, F.col("path") == F.col("_path"), "left").drop("path", "_path")


def newest_file(spark: SparkSession, folder: str) -> str | None:
    """Path of the file modified last (listing only)."""
    row = list_files(spark, folder).orderBy(F.desc("modified"), F.desc("path")).first()
    return row.path if row else None


def read_log_lines(spark: SparkSession, path) -> DataFrame:
    """Log lines as ``(source, block, line_no, line)``.

    ``block`` is the start of the input split inside the file.  Lines of one split are read in order by one task, so
    ``line_no`` (growing within a task) orders the lines inside a block, and blocks order by their start.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line_no"), F.col("value").alias("line"))
