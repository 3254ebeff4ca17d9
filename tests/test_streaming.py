import json

from pyspark.sql import functions as F

from strataflow.operators.scd import VERSION_COLUMNS  # noqa: F401
from strataflow.plans import attendance, employee, intake
from strataflow.streaming import ingest


def put(folder, name, docs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(d) + "\n" for d in docs))


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


def day(date, who, hours):
    return {"_airbyte_data": {"response": {"result": [{"Date": date, "employee_id": who, "working_hour": hours}]}}}


def test_files_are_ingested_once_and_upserted(spark, lake, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "done"
    def bronze():
        drain(ingest.ingest_to_bronze(lake, str(source), "hr.bronze.att", str(tmp_path / "c1"), archive=str(archive)))
    def upsert():
        drain(ingest.upsert_facts(lake, "hr.bronze.att", "hr.silver.att", lambda df: attendance.silver(df, keep_ingest=True), ["employee_id", "work_date"],
                                  "work_date", gold="hr.gold.att", to_gold=lambda df: df.select("employee_id", "work_minutes", "work_date"), checkpoint=str(tmp_path / "c2")))
    put(source, "a.jsonl", [day("2026-02-23", "7", "08:00"), day("2026-02-24", "7", "07:00")])
    bronze(), upsert()
    put(source, "b.jsonl", [day("2026-02-23", "7", "09:00"), day("2026-02-23", "8", "01:00")])
    bronze(), bronze(), upsert(), upsert()
    assert lake.read("hr.bronze.att").count() == 4
    for table in ("hr.silver.att", "hr.gold.att"):
        got = sorted((str(r.work_date), r.employee_id, r.work_minutes) for r in lake.read(table).collect())
        assert got == [("2026-02-23", "7", 540), ("2026-02-23", "8", 60), ("2026-02-24", "7", 420)]
    assert any(archive.rglob("a.jsonl"))


def test_repeated_batch_changes_nothing(spark, lake):
    rows = spark.createDataFrame([("7", "2026-02-23", 1, "a"), ("7", "2026-02-24", 1, "a")], "k string, d string, t int, v string").withColumn("d", F.to_date("d"))
    late = spark.createDataFrame([("7", "2026-02-23", 0, "late"), ("8", "2026-02-23", 5, "b")], "k string, d string, t int, v string").withColumn("d", F.to_date("d"))
    for batch in (rows, late, late, rows):
        ingest.latest_into_partitions(lake, batch, "c.silver.t", ["k", "d"], ["t"], "d")
    assert sorted((r.k, str(r.d), r.v) for r in lake.read("c.silver.t").collect()) == [("7", "2026-02-23", "a"), ("7", "2026-02-24", "a"), ("8", "2026-02-23", "b")]


def test_dimension_stream(spark, lake, tmp_path):
    source = tmp_path / "in"
    def run(stamp):
        drain(ingest.ingest_to_bronze(lake, str(source), "hr.bronze.emp"))
        drain(ingest.upsert_dimension(lake, "hr.bronze.emp", "hr.gold.dim", employee.silver, "employee_id", "dim_employee_key", F.lit(stamp).cast("timestamp")))
    put(source, "a.jsonl", [{"EmployeeID": "7", "FirstName": "J"}])
    run("2026-01-01")
    put(source, "b.jsonl", [{"EmployeeID": "7", "FirstName": "K"}])
    run("2026-02-01"), run("2026-03-01")
    got = sorted((r.first_name, r.is_current, str(r.valid_to)) for r in lake.read("hr.gold.dim").collect())
    assert got == [("J", 0, "2026-02-01 00:00:00"), ("K", 1, "None")]


def test_batch_and_stream_share_a_bronze_table(spark, lake, tmp_path):
    source, archive = tmp_path / "in", tmp_path / "batch"
    (tmp_path / "none").mkdir()
    put(source, "a.jsonl", [day("2026-02-23", "7", "08:00"), day("2026-02-24", "7", "07:00")])
    put(archive, "b.jsonl", [day("2026-02-25", "7", "08:00"), day("2026-02-25", "8", "07:00"), day("2026-02-25", "9", "07:00")])
    for table, order in (("hr.bronze.x", "sb"), ("hr.bronze.y", "bs")):
        for kind in order:
            if kind == "s":
                drain(ingest.ingest_to_bronze(lake, str(source), table, str(tmp_path / f"c-{table}")))
            else:
                intake.take_in(lake, str(archive), table)
        assert intake.bronze_lines(lake, table).count() == 5
        drain(ingest.ingest_to_bronze(lake, str(source), table, str(tmp_path / f"c-{table}")))
        assert intake.take_in(lake, str(tmp_path / "none"), table) == [] and intake.bronze_lines(lake, table).count() == 5


def test_a_repeated_micro_batch_replaces_itself(spark, lake):
    rows = spark.createDataFrame([("a",), ("b",)], "raw_json string")
    for _ in range(2):
        lake.write_bronze(rows, "hr.bronze.z", align=False, batch="stream-1-0")
    lake.write_bronze(rows, "hr.bronze.z", align=False)
    assert intake.bronze_lines(lake, "hr.bronze.z").count() == 4


def test_a_moved_key_leaves_no_row_and_no_partition_behind(spark, lake, tmp_path):
    def batch(*rows):
        return spark.createDataFrame(rows, "id int, d string, t int").withColumn("d", F.to_date("d"))
    ingest.latest_into_partitions(lake, batch((1, "2026-01-01", 1), (2, "2026-01-02", 1), (3, "2026-01-02", 1)), "c.silver.m", ["id"], ["t"], "d")
    for _ in range(2):
        ingest.latest_into_partitions(lake, batch((1, "2026-01-05", 2), (2, "2026-01-05", 2)), "c.silver.m", ["id"], ["t"], "d")
    got = sorted((r.id, str(r.d)) for r in lake.read("c.silver.m").collect())
    assert got == [(1, "2026-01-05"), (2, "2026-01-05"), (3, "2026-01-02")]


def test_added_columns_keep_the_partitions(spark, lake):
    df = spark.range(10).select("id", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"))
    lake.replace_partitions(df, "c.gold.p", "d")
    lake.add_columns("c.gold.p", {"note": "string"})
    assert lake.partition_columns("c.gold.p") == ["d"]
    one = df.where("d = '2026-01-03'").withColumn("note", F.lit("new"))
    lake.replace_partitions(one, "c.gold.p", "d")
    assert lake.read("c.gold.p", evolving=True).count() == 10
