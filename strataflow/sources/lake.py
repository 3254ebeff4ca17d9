"""Lake tables addressed as ``catalog.layer.table`` and stored as Parquet below one base path."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..operators.layout import stage
from ..operators.scd import apply_snapshot, first_history
from ..operators.upsert import absent

LAYERS = ("bronze", "silver", "gold")
CLOSED_BATCH = "closed_batch"
#: Partition column of bronze tables: one value per run or micro-batch.
BATCH = "ingest_batch"
NOT_CLOSED = "open"
SCD_PARTITIONS = ["is_current", CLOSED_BATCH]


def layer_and_table(name: str) -> tuple[str, str]:
    parts = name.split(".")
    if len(parts) != 3:
        raise ValueError(f"table name must be catalog.layer.table, got {name!r}")
    return parts[1], parts[2]


def _grouped(df: DataFrame, partition_by) -> DataFrame:
    """Rows of a table partition brought together before the write.

    Without it every task writes a file into every table partition.  Rebalancing, unlike repartitioning, merges small
    partitions and splits the large one of a hot date.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


class Lake:
    """Reads and writes the tables of one lake."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        layer, table = layer_and_table(name)
        return f"{self.base}/{layer}/{table}"

    def _file_system(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def exists(self, name: str) -> bool:
        fs, path = self._file_system(self.path(name))
        return fs.exists(path) and any(
            s.getPath().getName()[:1] not in "._" for s in fs.listStatus(path))

    def read(self, name: str, schema: T.StructType | None = None, evolving: bool = False) -> DataFrame:
        """The table.

        ``evolving`` merges the schemas of all files, for tables whose appends added columns; it reads every file footer.
        With ``schema`` no footer is read up front.
        """
        if schema is not None:
            return self.spark.read.schema(schema).parquet(self.path(name))
        return self.spark.read.option("mergeSchema", str(evolving).lower()).parquet(self.path(name))

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        """The table, or an empty frame of ``schema`` when it does not exist yet."""
        return self.read(name) if self.exists(name) else self.spark.createDataFrame([], schema)

    def append(self, df: DataFrame, name: str, partition_by=(), align: bool = True) -> None:
        """Append; columns the batch lacks are written as typed nulls, new columns are added to the table.

        Aligning needs the schemas of all files; turn it off for tables whose columns never change.
        """
        if self.streamed(name):
            raise ValueError(f"{name} is written by a file stream, whose log hides files appended beside it")
        if align and self.exists(name):
            df = self._aligned(df, name)
        df.write.mode("append").partitionBy(*partition_by).parquet(self.path(name))

    def _aligned(self, df: DataFrame, name: str) -> DataFrame:
        known = self.read(name, evolving=True).schema
        missing = [f for f in known.fields if f.name not in df.columns]
        return df.select(*[F.col(f"`{c}`").cast(known[c].dataType).alias(c) if c in known.fieldNames() else F.col(f"`{c}`")
                           for c in df.columns],
                         *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])

    def streamed(self, name: str) -> bool:
        """Whether a file sink keeps a log in the table's folder."""
        fs, path = self._file_system(f"{self.path(name)}/_spark_metadata")
        return fs.exists(path)

    def partition_columns(self, name: str) -> list[str]:
        """Partition columns of a table, read from its folders."""
        fs, path = self._file_system(self.path(name))
        found = []
        while True:
            folders = [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and "=" in s.getPath().getName()]
            if not folders:
                return found
            path = folders[0]
            found.append(path.getName().split("=")[0])

    def partition_values(self, name: str, column: str) -> list[str]:
        """Values of a table's first partition column, from its folders."""
        fs, path = self._file_system(self.path(name))
        names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        return sorted(unescape(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))

    def write_bronze(self, df: DataFrame, name: str, as_of: Column | None = None, align: bool = True, batch: str | None = None) -> None:
        """Add raw rows stamped with one ``ingest_timestamp``; the one writer of bronze tables, for batch runs and streams.

        Every batch is a partition of its own, named by ``batch`` or a fresh name.  Writing a named batch again replaces it,
        so an interrupted batch that is handed over again is not doubled.
        """
        stamp = F.current_timestamp() if as_of is None else as_of
        rows = df.withColumn("ingest_timestamp", stamp).withColumn(BATCH, F.lit(batch or f"run-{uuid.uuid4().hex}"))
        if align and self.exists(name):
            rows = self._aligned(rows, name)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.path(name))
        self.spark.catalog.refreshByPath(self.path(name))

    def overwrite(self, df: DataFrame, name: str, partition_by=()) -> None:
        """Replace the table's data and schema.

        The rows are written beside the table and swapped in afterwards, so ``df`` may read the table it replaces and a failed
        job leaves the old data in place.
        """
        target = self.path(name)
        staging, retired = (f"{target}__{kind}_{uuid.uuid4().hex}" for kind in ("staging", "retired"))
        _grouped(df, partition_by).write.mode("errorifexists").partitionBy(*partition_by).parquet(staging)
        fs, target_path = self._file_system(target)
        _, staging_path = self._file_system(staging)
        _, retired_path = self._file_system(retired)
        had_data = fs.exists(target_path)
        if had_data and not fs.rename(target_path, retired_path):
            raise OSError(f"could not move {target} aside")
        if not fs.rename(staging_path, target_path):
            if had_data:
                fs.rename(retired_path, target_path)
            raise OSError(f"could not move {staging} into place")
        if had_data:
            fs.delete(retired_path, True)
        self.spark.catalog.refreshByPath(target)

    def replace_partitions(self, df: DataFrame, name: str, partition_by, dates: DataFrame | None = None) -> None:
        """Delete-insert: exactly the partitions present in the batch are replaced, the others are not read or touched.

        ``dates``: all values (one column) of a single partition column that are to be replaced, also those for which ``df`` has
        no rows any more; their partitions are dropped.  The rows are stored first then, so they are computed once.
        """
        columns = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        if dates is not None:
            df = stage(df, "replacing")
            value = dates.columns[0]
            emptied = [r[0] for r in dates.distinct().join(df.select(F.col(columns[0]).alias("_kept")).distinct(),
                                                           F.col(value).eqNullSafe(F.col("_kept")), "left_anti")
                       .select(F.col(value).cast("string")).collect()]
        rows = _grouped(df, columns)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(self.path(name))
        if dates is not None:
            self._drop_partitions(name, columns[0], emptied)
        self.spark.catalog.refreshByPath(self.path(name))

    def _drop_partitions(self, name: str, column: str, values: list[str | None]) -> None:
        """Delete partition folders, named as Spark names them."""
        folder = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        for value in values:
            fs, path = self._file_system(f"{self.path(name)}/{folder(column, value)}")
            fs.delete(path, True)

    def insert_absent(self, df: DataFrame, name: str, key: str, partition_by=()) -> None:
        """Append the rows whose key the table lacks."""
        fresh = absent(df, self.read(name).select(key), key) if self.exists(name) else df
        self.append(fresh, name, partition_by)

    def apply_scd(self, snapshot: DataFrame, name: str, key: str, as_of: Column | None = None,
                  surrogate: str | None = None, expire_missing: bool = False) -> None:
        """Bring a type-2 dimension up to a snapshot.

        The table is partitioned into current versions and batches of closed versions.  A run reads and replaces the current
        partition and writes the versions it closes to a partition of their own; older history is never touched.
        """
        stamp = F.current_timestamp() if as_of is None else as_of
        # One fixed time for the whole run; it also names the partition of the versions closed by it.
        moment = self.spark.range(1).select(F.date_format(stamp, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("t")).first().t
        now, batch = F.lit(moment).cast("timestamp"), "at" + "".join(c for c in moment if c.isdigit())
        first_run = not self.exists(name)
        table = first_history(snapshot, surrogate) if first_run else self.read(name)
        if not first_run and not expire_missing:
            table = table.filter((F.col("is_current") == 1) | (F.col(CLOSED_BATCH) == batch))
        versions = apply_snapshot(table.drop(CLOSED_BATCH), snapshot, key, now, surrogate=surrogate, expire_missing=expire_missing)
        placed = versions.withColumn(CLOSED_BATCH, F.when(F.col("is_current") == 1, NOT_CLOSED).otherwise(
            F.date_format("valid_to", "'at'yyyyMMddHHmmssSSSSSS")))
        if expire_missing or first_run:
            self.overwrite(placed, name, SCD_PARTITIONS)
        else:
            self.replace_partitions(placed, name, SCD_PARTITIONS)

    def add_columns(self, name: str, columns: dict[str, str]) -> None:
        """Add missing columns as typed nulls."""
        df = self.read(name, evolving=True)
        new = {c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns}
        if new:
            self.overwrite(df.withColumns(new), name, self.partition_columns(name))

    def preview(self, name: str) -> DataFrame:
        """One row: row count, schema text and a first row as JSON."""
        df = self.read(name)
        return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(df.schema.simpleString()).alias("schema"),
                      F.first(F.to_json(F.struct("*"))).alias("sample"))


class LakeServing:
    """Serving tables kept in the lake, with the interface of :class:`strataflow.sources.jdbc.JdbcTables`."""

    def __init__(self, lake: Lake, catalog: str = "hr", layer: str = "serving"):
        self.lake, self.prefix = lake, f"{catalog}.{layer}"

    def replace_dates(self, df: DataFrame, table: str, date_col: str) -> None:
        self.lake.replace_partitions(df, f"{self.prefix}.{table}", date_col)

    def insert_absent(self, df: DataFrame, table: str, key: str) -> None:
        self.lake.insert_absent(df, f"{self.prefix}.{table}", key)

    def sync_dimension(self, versions: DataFrame, table: str, key: str, surrogate: str) -> None:
        """Bring a served type-2 dimension up to the given current versions: one join on the key, closed versions stay.

        Versions are closed first, into a partition named by the time of closing, then the current partition is replaced.  A sync
        that stopped in between finds the old current versions again and closes them into the same partition.
        """
        name = f"{self.prefix}.{table}"
        at = F.when(F.col("is_current") == 1, NOT_CLOSED).otherwise(F.date_format("valid_to", "'at'yyyyMMddHHmmssSSSSSS"))
        if not self.lake.exists(name):
            self.lake.overwrite(versions.withColumn(CLOSED_BATCH, at), name, SCD_PARTITIONS)
            return
        served = self.lake.read(name).where("is_current = 1").select(*versions.columns)
        fresh = versions.where("is_current = 1").select(F.struct(*[F.col(f"`{c}`") for c in versions.columns]).alias("new"))
        old = served.select(F.struct(*[F.col(f"`{c}`") for c in versions.columns]).alias("old"))
        joined = old.join(fresh, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
        replaced = F.col("old").isNotNull() & F.col("new").isNotNull() & (F.col(f"old.{surrogate}") != F.col(f"new.{surrogate}"))
        gone = F.col("old").withField("is_current", F.lit(0)).withField("valid_to", F.col("new.valid_from"))
        now = F.when(F.col("new").isNull(), F.col("old")).otherwise(F.col("new"))
        ready = stage(joined.select(F.when(replaced, gone).alias("closed"), now.alias("now")), "served")
        closed = ready.where("closed is not null").select("closed.*").withColumn(CLOSED_BATCH, at)
        batches = closed.select(F.col(CLOSED_BATCH).alias("_batch")).distinct()
        before = self.lake.read(name).where("is_current = 0").join(batches, F.col(CLOSED_BATCH) == F.col("_batch"), "left_semi").select(*closed.columns)
        self.lake.replace_partitions(stage(before.union(closed).dropDuplicates([surrogate]), "closed"), name, SCD_PARTITIONS)
        self.lake.replace_partitions(ready.select("now.*").withColumn(CLOSED_BATCH, at), name, SCD_PARTITIONS)


def create_schemas(spark: SparkSession, layers=LAYERS) -> None:
    for layer in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")


def create_table(spark: SparkSession, name: str, schema: T.StructType, partition_by=(), location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` from a schema."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET{parts}{place}")


def add_table_columns(spark: SparkSession, name: str, columns: dict[str, str]) -> None:
    """Add the columns a catalog table lacks."""
    known = {c.lower() for c in spark.table(name).columns}
    new = ", ".join(f"`{c}` {kind}" for c, kind in columns.items() if c.lower() not in known)
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({new})")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    rows = [(t.name, t.tableType, t.isTemporary) for t in spark.catalog.listTables(schema)]
    return spark.createDataFrame(rows, "name string, table_type string, is_temporary boolean")
