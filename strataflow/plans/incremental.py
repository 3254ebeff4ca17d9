"""Feeds kept up to date by the batches that are new, not by rebuilding everything.

Bronze has a partition per batch (:data:`~strataflow.sources.lake.BATCH`).  Beside the tables of a feed stand three small ones:

* ``<bronze>_taken``: the batches a consumer has finished.  A run reads the bronze partitions that are not listed, and lists them last.
* ``<silver>_places``: where keys have stood (key, partition), in slots by a hash of the key.  It tells which partitions of silver may
  hold an older row of a key without reading silver.  Places are added before silver changes and never taken away, so an interrupted
  run leaves none out.
* ``<gold>_refused``: keys of silver rows without a dimension row.  When one appears later, their partitions are built again.

A run that stopped anywhere can be repeated: partitions are replaced as a whole, and its batches are not listed yet.  A feed has one
writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions.casts import join_key
from ..operators.dims import current_rows
from ..operators.latest import keep_latest
from ..operators.layout import stage
from ..sources.lake import BATCH, Lake
from .intake import BRONZE_LINE

#: Slots of the table of places.
SLOTS = 16
#: Partition column of tables that are partitioned by more than a day.
PERIOD = "period"
TAKEN = T.StructType([T.StructField("consumer", T.StringType()), T.StructField(BATCH, T.StringType()),
                      T.StructField("taken_at", T.TimestampType())])
BRONZE_BATCHES = T.StructType(BRONZE_LINE.fields + [T.StructField(BATCH, T.StringType())])


def pending_batches(lake: Lake, bronze: str, consumer: str) -> list[str]:
    """Names of the bronze batches that the consumer has not finished; batch names are folder names, one per run."""
    if not lake.exists(bronze):
        return []
    names = lake.partition_values(bronze, BATCH)
    if not lake.exists(f"{bronze}_taken"):
        return names
    taken = lake.read(f"{bronze}_taken", TAKEN).where(F.col("consumer") == consumer).select(BATCH)
    listed = lake.spark.createDataFrame([(n,) for n in names], f"{BATCH} string")
    return sorted(r[0] for r in listed.join(taken, BATCH, "left_anti").collect())


def batch_rows(lake: Lake, bronze: str, names: list[str], schema: T.StructType = BRONZE_BATCHES) -> DataFrame:
    """Rows of some bronze batches; no other partition is listed or read."""
    return lake.read(bronze, schema).where(F.col(BATCH).isin(names)).drop(BATCH)


def mark_taken(lake: Lake, bronze: str, consumer: str, names: list[str]) -> None:
    rows = lake.spark.createDataFrame([(consumer, n) for n in names], f"consumer string, {BATCH} string")
    lake.append(rows.withColumn("taken_at", F.current_timestamp()), f"{bronze}_taken", align=False)


@dataclass(frozen=True)
class Feed:
    """A feed with one silver row per key.

    ``transform`` turns bronze rows into silver rows that keep ``order``; ``gold`` turns silver rows into facts.  Tables are
    partitioned by ``date_col``, or by its month or year if ``period`` says so.  ``person`` is the silver column by which facts find
    their employee and ``person_key`` the dimension's.  Keys that include the date never move and need no table of places.
    """

    bronze: str
    silver: str
    gold: str
    keys: tuple[str, ...]
    date_col: str
    transform: Callable[[DataFrame], DataFrame]
    to_gold: Callable[[DataFrame, DataFrame, DataFrame], DataFrame]
    person: str = "employee_id"
    person_key: str = "employee_id"
    order: str = "ingest_timestamp"
    period: str | None = None

    @property
    def part(self) -> str:
        return PERIOD if self.period else self.date_col

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PERIOD, F.trunc(self.date_col, self.period)) if self.period else df

    @property
    def moves(self) -> bool:
        return self.date_col not in self.keys


def _same(left, right) -> Column:
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _slot(keys) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(SLOTS)).cast("int")


def _renamed(df: DataFrame, keys) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct().withColumn("_slot", _slot([f"_key_{k}" for k in keys]))


def _earlier_places(lake: Lake, feed: Feed, rows: DataFrame) -> DataFrame:
    """Partitions where keys of the batch may stand; places the table lacks are added to it."""
    name, keys = f"{feed.silver}_places", list(feed.keys)
    fresh = rows.select(*keys, feed.part).distinct().withColumn("slot", _slot(keys))
    if not lake.exists(name):
        lake.append(fresh.repartition("slot"), name, ["slot"], align=False)
        return rows.select(feed.part).limit(0)
    layout = T.StructType([*[rows.schema[c] for c in (*keys, feed.part)], T.StructField("slot", T.IntegerType())])
    known = lake.read(name, layout)
    wanted = _renamed(rows, keys)
    # The slot in the condition lets the scan skip slots without keys of the batch.
    found = stage(known.join(wanted, (F.col("slot") == F.col("_slot")) & _same(keys, [f"_key_{k}" for k in keys]), "left_semi"), "places")
    columns = [*keys, feed.part]
    old = found.select(*[F.col(c).alias(f"_old_{c}") for c in columns]).distinct()
    lake.append(fresh.join(old, _same(columns, [f"_old_{c}" for c in columns]), "left_anti").repartition("slot"), name, ["slot"], align=False)
    return found.select(feed.part)


def _resolved_now(lake: Lake, feed: Feed, employees: DataFrame, layout: T.StructType) -> DataFrame | None:
    """Partitions with refused rows whose employee is known now."""
    name = f"{feed.gold}_refused"
    if not lake.exists(name):
        return None
    refused = lake.read(name, T.StructType([layout[c] for c in (feed.person, feed.part)]))
    people = current_rows(employees).select(join_key(F.col(feed.person_key)).alias("_person"))
    return refused.join(people, join_key(F.col(feed.person)) == F.col("_person"), "left_semi").select(feed.part)


def load_new(lake: Lake, feed: Feed, employees: DataFrame, dates: DataFrame) -> DataFrame | None:
    """Take all new bronze batches into silver and gold; the partitions replaced (one column), or None if nothing was to be done.

    Facts keep the dimension keys of the run that built their partition.
    """
    names = pending_batches(lake, feed.bronze, feed.silver)
    rows = stage(feed.placed(feed.transform(batch_rows(lake, feed.bronze, names))), "batch-rows") if names else None
    if rows is None:
        if not lake.exists(feed.silver):
            return None
        layout = feed.placed(feed.transform(batch_rows(lake, feed.bronze, []))).schema
    else:
        layout = rows.schema
    touched = [] if rows is None else [rows.select(feed.part)]
    if rows is not None and feed.moves:
        touched.append(_earlier_places(lake, feed, rows))
    late = _resolved_now(lake, feed, employees, layout)
    touched += [] if late is None else [late]
    if not touched:
        return None
    parts = stage(reduce(DataFrame.union, touched).select(F.col(feed.part).alias("_part")).distinct(), "batch-parts")
    if parts.isEmpty():
        if names:
            mark_taken(lake, feed.bronze, feed.silver, names)
        return None
    known = None
    if lake.exists(feed.silver):
        known = lake.read(feed.silver, layout).join(parts, F.col(feed.part).eqNullSafe(F.col("_part")), "left_semi").select(*layout.names)
    both = known if rows is None else rows if known is None else known.union(rows)
    # Columns in one order, so that ties are broken as in a rebuild.
    merged = stage(keep_latest(both, list(feed.keys), [feed.order]), "merged")
    facts = feed.placed(feed.to_gold(merged, employees, dates))
    people = current_rows(employees).select(join_key(F.col(feed.person_key)).alias("_person"))
    refused = merged.select(feed.person, feed.part).join(people, join_key(F.col(feed.person)) == F.col("_person"), "left_anti").distinct()
    if rows is not None:
        lake.replace_partitions(merged, feed.silver, feed.part, parts)
    lake.replace_partitions(facts, feed.gold, feed.part, parts)
    lake.replace_partitions(refused, f"{feed.gold}_refused", feed.part, parts)
    if names:
        mark_taken(lake, feed.bronze, feed.silver, names)
    return parts


def load_new_dimension(lake: Lake, bronze: str, silver: str, dimension: str, key: str, transform: Callable[[DataFrame], DataFrame],
                       surrogate: str | None = None, as_of: Column | None = None, order: str = "ingest_timestamp") -> bool:
    """Take all new bronze batches into silver (one row per key, with ``order``) and the type-2 dimension; False without any.

    Only keys of the new batches are compared with the dimension; all others stay as they are.
    """
    names = pending_batches(lake, bronze, silver)
    if not names:
        return False
    rows = stage(transform(batch_rows(lake, bronze, names)), "batch-rows")
    both = lake.read(silver, rows.schema).select(*rows.columns).union(rows) if lake.exists(silver) else rows
    merged = stage(keep_latest(both, [key], [order]), "merged")
    lake.overwrite(merged, silver)
    changed = merged.join(rows.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_semi")
    lake.apply_scd(changed.drop(order), dimension, key, as_of, surrogate=surrogate)
    mark_taken(lake, bronze, silver, names)
    return True
