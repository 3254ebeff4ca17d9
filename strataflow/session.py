"""Session construction."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the operators rely on.  Adaptive execution measures each shuffle at run time,
# broadcasts a join side only when its measured size allows it, and splits skewed join
# partitions.  The shuffle partition count is left alone: adaptive coalescing
# shrinks it and the cluster's own default sets the ceiling.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "strataflow", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`ENGINE_CONF` and the caller's overrides."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Set the run-time part of :data:`ENGINE_CONF` on a session somebody else created."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def stream_checkpoint(spark: SparkSession, name: str, explicit: str | None = None) -> str:
    """Checkpoint location of a stream: given, or below the cluster's shared ``spark.checkpoint.dir``."""
    if explicit:
        return explicit
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("pass a checkpoint location or set spark.checkpoint.dir")
    return f"{shared.rstrip('/')}/streams/{name}"
