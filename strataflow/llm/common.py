"""Shared parts: intermediate tables, Arrow passes over texts, chunked work on large groups."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule (space, tab, line feed, vertical tab, form feed, carriage return), as a Java regular expression.
SPACE = r"[\x20\x09-\x0D]+"
#: A word is a longest run of other characters.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one of our own only where none is set and the session is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="strataflow-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Bytes of a row group of stored tables: what a task that writes whole texts or sets holds before it flushes.
ROW_GROUP = 32 << 20


def stored(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """Write a frame as a Parquet table in the shared folder and read it back.

    Work before the table is done once, also when executors are lost later.  The table is deleted when the application
    ends (results are lazy and may read it until then).
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/strataflow-llm/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).option("parquet.block.size", ROW_GROUP).parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, size: int = 8 << 20):
    """Arrow batches of at most so many bytes for the jobs run inside: few whole texts or sets are in memory at a time."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def small_reads(spark: SparkSession, size: int = 4 << 20):
    """At most so many bytes of files a task for the jobs run inside: for stored rows of which each is much work."""
    return _setting(spark, "spark.sql.files.maxPartitionBytes", str(size))


def per_row(df: DataFrame, schema: str, make: Callable[[], Callable[..., tuple]], rows: int = 256) -> DataFrame:
    """Map rows one to one in Arrow batches.

    ``make()`` is called once per task and returns a function from a row's values to the output values.  Output is
    handed over every ``rows`` rows, so that a batch of long texts never has all its results in memory.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = [work(*values) for values in zip(*(column.to_pylist() for column in part.columns))]
                columns = list(zip(*out)) or [[] for _ in target]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

    return df.mapInArrow(run, schema)
