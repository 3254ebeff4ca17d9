"""Feeds by new batches: equal to a rebuild, repeatable after a failure, reading new partitions only."""

import json

import pytest
from pyspark.sql import functions as F

from strataflow.plans import employee, incremental, leave, timesheet
from strataflow.plans.intake import bronze_lines
from strataflow.sources.lake import BATCH

PEOPLE = "dim_employee_key long, employee_id string, email_id string, is_current int"


@pytest.fixture
def dates(spark):
    return spark.sql("select cast(date_format(d,'yyyyMMdd') as int) dim_date_key, d full_date from "
                     "(select explode(sequence(date'2026-02-01', date'2026-03-31')) d)")


def logs(*rows):
    texts = [json.dumps({"timelogId": i, "workDate": d, "employeeMailId": who, "hoursInMins": str(m)}) for i, d, who, m in rows]
    return json.dumps({"response": {"result": texts}})


def put(spark, lake, bronze, batch, when, *lines):
    df = spark.createDataFrame([(x,) for x in lines], "raw_json string")
    lake.write_bronze(df, bronze, F.lit(when).cast("timestamp"), align=False, batch=batch)


def facts(lake, feed):
    return sorted((r.timelog_id, str(r.work_date), r.minutes_int, r.dim_employee_key) for r in lake.read(feed.gold).collect())


def rebuilt(lake, feed, people, dates):
    gold = timesheet.gold(timesheet.silver(bronze_lines(lake, feed.bronze)), people, dates)
    return sorted((r.timelog_id, str(r.work_date), r.minutes_int, r.dim_employee_key) for r in gold.collect())


@pytest.mark.parametrize("period", [None, "month"])
def test_moved_keys_and_late_people(spark, lake, dates, period):
    feed = timesheet.feed(period=period)
    some = spark.createDataFrame([(1, "7", "a@x", 1)], PEOPLE)
    everyone = spark.createDataFrame([(1, "7", "a@x", 1), (2, "8", "b@x", 1), (3, "9", "c@x", 0)], PEOPLE)
    put(spark, lake, feed.bronze, "b1", "2026-03-01", logs(("1", "2026-02-03", "a@x", 10), ("2", "2026-02-04", "b@x", 20), ("3", "2026-02-05", "c@x", 30)))
    assert incremental.load_new(lake, feed, some, dates).count() == (1 if period else 3)
    assert facts(lake, feed) == [("1", "2026-02-03", 10, 1)]
    assert incremental.load_new(lake, feed, some, dates) is None
    # A log moves to another month, then back; an older batch comes late; a person appears without any new batch.
    put(spark, lake, feed.bronze, "b2", "2026-03-02", logs(("1", "2026-03-09", "a@x", 11)), logs(("4", "2026-02-05", "a@x", 40)))
    incremental.load_new(lake, feed, some, dates)
    assert facts(lake, feed) == rebuilt(lake, feed, some, dates) == [("1", "2026-03-09", 11, 1), ("4", "2026-02-05", 40, 1)]
    incremental.load_new(lake, feed, everyone, dates)
    assert facts(lake, feed) == rebuilt(lake, feed, everyone, dates) and len(facts(lake, feed)) == 3
    put(spark, lake, feed.bronze, "b3", "2026-03-03", logs(("1", "2026-02-04", "b@x", 12)))
    put(spark, lake, feed.bronze, "b4", "2026-02-28", logs(("2", "2026-02-20", "a@x", 1), ("1", "2026-02-21", "a@x", 1)))
    incremental.load_new(lake, feed, everyone, dates)
    assert facts(lake, feed) == rebuilt(lake, feed, everyone, dates) == [("1", "2026-02-04", 12, 2), ("2", "2026-02-04", 20, 2), ("4", "2026-02-05", 40, 1)]
    assert incremental.load_new(lake, feed, everyone, dates) is None


@pytest.mark.parametrize("table", ["silver", "gold", "taken"])
def test_a_run_that_failed_is_repeated(spark, lake, dates, monkeypatch, table):
    """Stopped before silver, before gold, or before the batch is listed; meanwhile another batch moves the key on."""
    feed = timesheet.feed()
    people = spark.createDataFrame([(1, "7", "a@x", 1)], PEOPLE)
    put(spark, lake, feed.bronze, "b1", "2026-03-01", logs(("1", "2026-02-03", "a@x", 10), ("2", "2026-02-03", "a@x", 20)))
    incremental.load_new(lake, feed, people, dates)
    put(spark, lake, feed.bronze, "b2", "2026-03-02", logs(("1", "2026-02-10", "a@x", 11)))

    def fail(*_, **__):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        if table == "taken":
            m.setattr(incremental, "mark_taken", fail)
        else:
            write = type(lake).replace_partitions
            m.setattr(type(lake), "replace_partitions", lambda self, df, name, *a: fail() if f".{table}." in name else write(self, df, name, *a))
        with pytest.raises(OSError):
            incremental.load_new(lake, feed, people, dates)
    put(spark, lake, feed.bronze, "b3", "2026-03-03", logs(("1", "2026-02-20", "a@x", 12)))
    incremental.load_new(lake, feed, people, dates)
    assert facts(lake, feed) == rebuilt(lake, feed, people, dates) == [("1", "2026-02-20", 12, 1), ("2", "2026-02-03", 20, 1)]
    assert lake.read(feed.silver).count() == 2


def test_only_new_batches_are_read(spark, lake, tmp_path):
    for k in range(3):
        put(spark, lake, "hr.bronze.x", f"b{k}", "2026-03-01", f"line {k}")
    assert incremental.pending_batches(lake, "hr.bronze.x", "one") == ["b0", "b1", "b2"]
    incremental.mark_taken(lake, "hr.bronze.x", "one", ["b0", "b2"])
    assert incremental.pending_batches(lake, "hr.bronze.x", "one") == ["b1"]
    assert incremental.pending_batches(lake, "hr.bronze.x", "other") == ["b0", "b1", "b2"]
    assert incremental.pending_batches(lake, "hr.bronze.none", "one") == []
    rows = incremental.batch_rows(lake, "hr.bronze.x", ["b1"])
    assert [r.raw_json for r in rows.collect()] == ["line 1"] and BATCH not in rows.columns
    assert "PartitionFilters: [isnotnull(ingest_batch" in rows._jdf.queryExecution().executedPlan().toString()
    # Files of other batches are not even opened.
    for path in (tmp_path / "lake/bronze/x").rglob("*.parquet"):
        if "=b1" not in str(path):
            path.write_bytes(b"no parquet")
    assert incremental.batch_rows(lake, "hr.bronze.x", ["b1"]).count() == 1


def test_leave_without_dates_or_rows(spark, lake, dates):
    feed, people = leave.feed(), spark.createDataFrame([(1, "7", "a@x", 1)], PEOPLE)
    put(spark, lake, feed.bronze, "b1", "2026-03-01", "noise", "{}")
    assert incremental.load_new(lake, feed, people, dates) is None
    assert incremental.pending_batches(lake, feed.bronze, feed.silver) == []
    record = {"EmployeeId": "7", "Zoho.ID": 11, "From": "23-Feb-2026", "To": "24-Feb-2026"}
    put(spark, lake, feed.bronze, "b2", "2026-03-02", json.dumps({"result": {"r1": record}}))
    put(spark, lake, feed.bronze, "b3", "2026-03-03", json.dumps({"result": {"r1": {**record, "From": "25-Feb-2026"}}}))
    incremental.load_new(lake, feed, people, dates)
    assert [(r.source_leave_id, str(r.from_date)) for r in lake.read(feed.gold).collect()] == [(11, "2026-02-25")]
    assert "ingest_timestamp" in lake.read(feed.silver).columns


def test_dimension_by_changed_records(spark, lake):
    def load(batch, when, *people):
        put(spark, lake, "hr.bronze.employee_raw", batch, when, json.dumps([{"EmployeeID": i, "FirstName": n} for i, n in people]))
        assert employee.load(lake, as_of=F.lit(when).cast("timestamp"))
    load("b1", "2026-01-01", ("1", "A"), ("2", "B"))
    load("b2", "2026-02-01", ("2", "C"))
    assert not employee.load(lake)
    got = sorted((r.employee_id, r.first_name, r.is_current, str(r.valid_from)[:10]) for r in lake.read("hr.gold.dim_employee").collect())
    assert got == [("1", "A", 1, "2026-01-01"), ("2", "B", 0, "2026-01-01"), ("2", "C", 1, "2026-02-01")]
    assert lake.read("hr.silver.employee_cleaned").count() == 2


def test_emptied_partitions_with_odd_names_are_dropped(spark, lake):
    def rows(*values):
        return spark.createDataFrame([(v,) for v in values], "p string").withColumn("k", F.lit(1))
    lake.replace_partitions(rows("a:b", "c/d", "e", None), "c.gold.odd", "p")
    gone = spark.createDataFrame([("a:b",), ("c/d",), (None,)], "v string")
    lake.replace_partitions(rows("f").limit(0), "c.gold.odd", "p", gone)
    assert [r.p for r in lake.read("c.gold.odd").collect()] == ["e"]
