"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Export formats by extension.
EXPORT_FORMATS = {".csv": "csv", ".json": "json", ".parquet": "parquet"}


def export(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write in the format the path's extension names."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    extension = "." + name.rsplit(".", 1)[-1].lower() if "." in name else ""
    if extension not in EXPORT_FORMATS:
        raise ValueError(f"unsupported export format {extension!r}")
    writer = df.write.mode(mode)
    if extension == ".csv":
        writer = writer.option("header", "true")
    writer.format(EXPORT_FORMATS[extension]).save(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_report(report: DataFrame, path: str, job: str = "job_id", mode: str = "overwrite") -> None:
    """Report rows as text files below one directory per job, each file in report order.

    Range partitioning by job and position lets a long report span several files, which sort by name.
    """
    ordered = report.repartitionByRange(F.col(job), F.col("section"), F.col("seq"), F.col("line"), F.col("text")) \
        .sortWithinPartitions(job, "section", "seq", "line", "text")
    ordered.select(job, "text").write.mode(mode).partitionBy(job).text(path)
