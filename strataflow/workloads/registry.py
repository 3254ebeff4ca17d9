"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_runtime_conf


class Tables:
    """Attribute access to the Parquet tables of a directory."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder.rstrip("/")

    def spread(self, name: str) -> DataFrame:
        """A table for CPU-heavy work.

        Files of one row group are one task.  A session that reads such files names the number of partitions to spread them
        over in ``strataflow.spread``; without that setting rows stay where they are read, whatever their size.
        """
        parts = self.spark.conf.get("strataflow.spread", None)
        table = getattr(self, name)
        return table.repartition(int(parts)) if parts else table

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(apply_runtime_conf(spark), folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(build, sql)
        return build
    return register
