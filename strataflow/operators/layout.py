"""Physical layout helpers: storing shared intermediate results."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="strataflow-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stage(df: DataFrame, label: str) -> DataFrame:
    """Store an intermediate result that several branches of a plan read, and return the stored table.

    The table lives in the shared folder, so the work before it is done once and losing an executor does not bring it
    back.  Results are lazy and may read it until the application ends; then it is deleted.  :func:`release` deletes it
    earlier, and the end of a :func:`scratch` those made in it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    scopes = getattr(_SCOPES, "open", None)
    (scopes[-1] if scopes else _STAGED).append(path)
    return spark.read.schema(df.schema).parquet(path)


_STAGED: list[str] = []
#: Open scopes of each thread.
_SCOPES = threading.local()


def _delete(spark: SparkSession, paths: list[str]) -> int:
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.delete(where, True)
        fs.cancelDeleteOnExit(where)
    return len(paths)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables this thread stages inside are deleted at the end, also after an error; those of other runs stay.

    For work that writes all its results inside, such as a micro-batch: results that are still lazy cannot be read afterwards.
    """
    scopes = _SCOPES.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        _delete(spark, scopes.pop())


def release(spark: SparkSession) -> int:
    """Delete everything staged so far outside of scopes, once the results that read it are written; the number of tables deleted."""
    paths, _STAGED[:] = list(_STAGED), []
    return _delete(spark, paths)
