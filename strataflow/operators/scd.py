"""Type-2 dimension versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

VERSION_COLUMNS = {"valid_from": "timestamp", "valid_to": "timestamp", "is_current": "int",
                   "dw_load_timestamp": "timestamp"}


def change_classes(snapshot: DataFrame, current: DataFrame, key: str, hash_col: str = "record_hash",
                   name: str = "change_class") -> DataFrame:
    """Each snapshot row labelled ``new``, ``changed`` or ``unchanged`` against the current versions.

    The hash comparison is null-safe: a current row without a hash counts as changed.  The merge hint keeps the
    join sorted on the key that the snapshot is already partitioned by.
    """
    old = current.select(F.col(key).alias("_old_key"), F.col(hash_col).alias("_old_hash"))
    joined = snapshot.join(old.hint("merge"), F.col(key) == F.col("_old_key"), "left")
    label = (F.when(F.col("_old_key").isNull(), "new")
             .when(~F.col(hash_col).eqNullSafe(F.col("_old_hash")), "changed")
             .otherwise("unchanged"))
    return joined.withColumn(name, label).drop("_old_key", "_old_hash")


def _fields(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _as_struct(prefix: str, own: dict, layout: dict, overrides: dict[str, Column]) -> Column:
    def field(name, kind):
        if name in overrides:
            value = overrides[name]
        elif name in own:
            value = F.col(f"{prefix}.`{name}`")
        else:
            value = F.lit(None)
        return value.cast(kind).alias(name)
    return F.struct(*[field(n, k) for n, k in layout.items()])


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, as_of: Column | None = None,
                   hash_col: str = "record_hash", surrogate: str | None = None,
                   expire_missing: bool = False) -> DataFrame:
    """The dimension after one snapshot: past versions, current versions (closed where changed), new versions.

    One full outer join of the current versions with the snapshot; each joined row is turned into
    the one or two versions it stands for, so neither side is read twice.  Both sides hold a key at most
    once, hence no key can skew the join, and past versions never take part in it.
    Applying the same snapshot again changes nothing.  Keys absent from the snapshot stay current unless
    ``expire_missing`` is set.  ``surrogate`` names a bigint version key to be derived from key, hash and
    start.
    """
    now = F.current_timestamp() if as_of is None else as_of
    layout = dict(_fields(history))
    for name, kind in _fields(snapshot).items():
        layout.setdefault(name, kind)
    if surrogate:
        layout.setdefault(surrogate, T.LongType())

    is_current = F.coalesce(F.col("is_current") == 1, F.lit(False))
    past = history.filter(~is_current)
    current = history.filter(is_current).select(F.struct(*[F.col(f"`{c}`") for c in history.columns]).alias("old"))
    fresh = snapshot.select(F.struct(*[F.col(f"`{c}`") for c in snapshot.columns]).alias("new"))
    joined = current.join(fresh, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    in_both = F.col("old").isNotNull() & F.col("new").isNotNull()
    hash_before = F.col(f"old.{hash_col}") if hash_col in history.columns else F.lit(None).cast("string")
    changed = in_both & ~F.col(f"new.{hash_col}").eqNullSafe(hash_before)
    closes = changed | (F.col("old").isNotNull() & F.col("new").isNull()) if expire_missing else changed

    kept = _as_struct("old", _fields(history), layout, {
        "valid_to": F.when(closes, now).otherwise(F.col("old.valid_to")),
        "is_current": F.when(closes, F.lit(0)).otherwise(F.col("old.is_current"))})
    stamps = {"valid_from": now, "valid_to": F.lit(None), "is_current": F.lit(1), "dw_load_timestamp": now}
    if surrogate:
        stamps[surrogate] = F.xxhash64(F.col(f"new.{key}"), F.col(f"new.{hash_col}"), now.cast("timestamp"))
    added = _as_struct("new", _fields(snapshot), layout, stamps)

    versions = F.array_compact(F.array(
        F.when(F.col("old").isNotNull(), kept),
        F.when(F.col("new").isNotNull() & (F.col("old").isNull() | changed), added)))
    return joined.select(F.inline(versions)).unionByName(past, allowMissingColumns=True)


def first_history(snapshot: DataFrame, surrogate: str | None = None) -> DataFrame:
    """Empty dimension with the snapshot's columns plus the version columns, for a first load.

    The optimizer sees that it is empty and drops the join with it.
    """
    columns = [F.col(f"`{c}`") for c in snapshot.columns]
    columns += [F.lit(None).cast(kind).alias(n) for n, kind in VERSION_COLUMNS.items() if n not in snapshot.columns]
    if surrogate:
        columns.append(F.lit(None).cast("bigint").alias(surrogate))
    return snapshot.select(*columns).limit(0)
