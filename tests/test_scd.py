import pytest
from pyspark.sql import functions as F

from strataflow.functions.text import record_hash
from strataflow.operators import scd


def snapshot(spark, rows):
    return spark.createDataFrame(rows, "employee_id string, name string, dept string").withColumn("record_hash", record_hash(["name", "dept"]))


def at(text):
    return F.lit(text).cast("timestamp")


V1 = [("a", "Ann", "X"), ("b", "Bob", "X"), ("c", "Cy", None)]
V2 = [("a", "Ann", "Y"), ("b", "Bob", "X"), ("d", "Di", "Z")]


@pytest.fixture
def history(spark):
    first = snapshot(spark, V1)
    return scd.apply_snapshot(scd.first_history(first, "key"), first, "employee_id", at("2024-01-01"), surrogate="key")


def rows(df):
    return sorted((r.employee_id, r.dept, str(r.valid_from)[:10], str(r.valid_to)[:10], r.is_current) for r in df.collect())


def test_first_load_and_change(spark, history):
    assert [r[4] for r in rows(history)] == [1, 1, 1]
    second = scd.apply_snapshot(history, snapshot(spark, V2), "employee_id", at("2024-02-01"), surrogate="key")
    assert rows(second) == [("a", "X", "2024-01-01", "2024-02-01", 0), ("a", "Y", "2024-02-01", "None", 1), ("b", "X", "2024-01-01", "None", 1),
                            ("c", None, "2024-01-01", "None", 1), ("d", "Z", "2024-02-01", "None", 1)]
    keys = [r.key for r in second.collect()]
    assert len(set(keys)) == len(keys)


def test_reapplying_changes_nothing(spark, history):
    second = scd.apply_snapshot(history, snapshot(spark, V2), "employee_id", at("2024-02-01"), surrogate="key")
    third = scd.apply_snapshot(second, snapshot(spark, V2), "employee_id", at("2024-03-01"), surrogate="key")
    assert rows(third) == rows(second)


def test_one_current_row_and_no_overlap_after_reverting(spark, history):
    df = history
    for when, version in (("2024-02-01", V2), ("2024-03-01", V1), ("2024-04-01", V2)):
        df = scd.apply_snapshot(df, snapshot(spark, version), "employee_id", at(when), surrogate="key")
    per_key = {}
    for r in df.collect():
        per_key.setdefault(r.employee_id, []).append((r.valid_from, r.valid_to, r.is_current))
    for versions in per_key.values():
        versions.sort(key=lambda v: v[0])
        assert sum(v[2] for v in versions) == 1 and versions[-1][2] == 1
        assert all(a[1] == b[0] for a, b in zip(versions, versions[1:]))


def test_null_hash_counts_as_changed(spark, history):
    unhashed = history.withColumn("record_hash", F.lit(None).cast("string"))
    classes = scd.change_classes(snapshot(spark, V2), unhashed, "employee_id")
    assert {r.employee_id: r.change_class for r in classes.collect()} == {"a": "changed", "b": "changed", "d": "new"}


def test_missing_rows_expire_on_request(spark, history):
    second = scd.apply_snapshot(history, snapshot(spark, V2), "employee_id", at("2024-02-01"), expire_missing=True)
    assert [r for r in rows(second) if r[0] == "c"] == [("c", None, "2024-01-01", "2024-02-01", 0)]


def test_new_snapshot_columns_are_added(spark, history):
    wider = snapshot(spark, V2).withColumn("grade", F.lit(3))
    got = scd.apply_snapshot(history, wider, "employee_id", at("2024-02-01"))
    assert {(r.employee_id, r.is_current): r.grade for r in got.collect()}[("a", 1)] == 3
