import pytest
from pyspark.sql import functions as F

from strataflow.plans.ddl import create_gold_tables, gold_schemas
from strataflow.sources import files, jdbc, sinks
from strataflow.sources.lake import LakeServing, add_table_columns, layer_and_table, list_tables, read_table


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, d string, v string").withColumn("d", F.to_date("d"))


def content(df):
    return sorted((r.k, str(r.d), r.v) for r in df.collect())


def test_table_names():
    assert layer_and_table("c.gold.t") == ("gold", "t")
    with pytest.raises(ValueError):
        layer_and_table("gold.t")


def test_overwrite_a_table_that_is_being_read(spark, lake):
    lake.overwrite(frame(spark, (1, "2026-01-01", "a")), "c.silver.t")
    lake.overwrite(lake.read("c.silver.t").withColumn("v", F.lit("b")), "c.silver.t")
    assert content(lake.read("c.silver.t")) == [(1, "2026-01-01", "b")]


def test_failed_overwrite_keeps_the_old_data(spark, lake):
    lake.overwrite(frame(spark, (1, "2026-01-01", "a")), "c.silver.t")
    with pytest.raises(Exception):
        lake.overwrite(lake.read("c.silver.t").withColumn("v", F.raise_error(F.lit("boom")).cast("string")), "c.silver.t")
    assert content(lake.read("c.silver.t")) == [(1, "2026-01-01", "a")]


def test_bronze_appends_with_schema_evolution(spark, lake):
    lake.write_bronze(spark.createDataFrame([("x",)], "raw_json string"), "c.bronze.t", F.lit("2026-01-01").cast("timestamp"))
    lake.write_bronze(spark.createDataFrame([("y", 1)], "raw_json string, extra int"), "c.bronze.t")
    lake.write_bronze(spark.createDataFrame([("z",)], "raw_json string"), "c.bronze.t")
    got = sorted((r.raw_json, r.extra) for r in lake.read("c.bronze.t", evolving=True).collect())
    assert got == [("x", None), ("y", 1), ("z", None)]


def test_replace_partitions_touches_only_the_batch_and_is_idempotent(spark, lake):
    lake.replace_partitions(frame(spark, (1, "2026-01-01", "a"), (2, "2026-01-02", "a")), "c.gold.t", "d")
    batch = frame(spark, (3, "2026-01-02", "b"), (4, None, "b"))
    for _ in range(2):
        lake.replace_partitions(batch, "c.gold.t", "d")
        assert content(lake.read("c.gold.t")) == [(1, "2026-01-01", "a"), (3, "2026-01-02", "b"), (4, "None", "b")]


def test_insert_absent(spark, lake):
    serving = LakeServing(lake, "c")
    for v in ("a", "b"):
        serving.insert_absent(frame(spark, (1, "2026-01-01", v)), "t", "k")
    serving.insert_absent(frame(spark, (1, "2026-01-01", "c"), (2, "2026-01-01", "c")), "t", "k")
    assert content(lake.read("c.serving.t")) == [(1, "2026-01-01", "a"), (2, "2026-01-01", "c")]


def test_missing_table_columns_and_preview(spark, lake):
    df = frame(spark, (1, "2026-01-01", "a"))
    assert lake.read_or_empty("c.gold.t", df.schema).count() == 0
    lake.overwrite(df, "c.gold.t")
    lake.add_columns("c.gold.t", {"record_hash": "string", "v": "string"})
    assert lake.read("c.gold.t").columns == ["k", "d", "v", "record_hash"]
    row = lake.preview("c.gold.t").first()
    assert row.rows == 1 and "record_hash" in row.schema and '"k":1' in row.sample


def test_gold_ddl(spark):
    create_gold_tables(spark)
    create_gold_tables(spark)
    assert {r.name for r in list_tables(spark, "gold").collect()} >= set(gold_schemas())
    add_table_columns(spark, "gold.fact_leave", {"note": "string", "reason": "string"})
    assert read_table(spark, "gold.fact_leave").columns[-1] == "note"
    assert gold_schemas()["fact_attendance"]["source_attendance_id"].dataType.simpleString() == "bigint"


def test_file_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x":1}\n{"x":2}\n')
    (tmp_path / "b_failed_parse.jsonl").write_text("bad\n")
    (tmp_path / "c.XLSX").write_text("x")
    base = str(tmp_path)
    assert files.read_raw_lines(spark, base, exclude="_failed_parse").count() == 2
    assert files.list_files(spark, base, ".jsonl", exclude="_failed_parse").count() == 1
    assert files.list_files(spark, base, ".xlsx", ignore_case=True).count() == 1
    assert files.read_files(spark, []) is None
    assert files.read_files(spark, [f"{base}/a.jsonl"], "json", "x int").agg(F.sum("x")).first()[0] == 3
    with pytest.raises(ValueError):
        files.read_files(spark, [base], "xml")


def test_csv_and_export(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,x\n2,y,z\n,\n")
    df = files.read_rule_input(spark, str(tmp_path / "in.csv"), "a int, b string")
    assert [(r.a, r.b) for r in df.collect()] == [(1, "x")]
    for ext in ("csv", "json", "parquet"):
        sinks.export(df, str(tmp_path / f"out.{ext}"))
    assert spark.read.json(str(tmp_path / "out.json")).count() == 1
    with pytest.raises(ValueError):
        sinks.export(df, str(tmp_path / "out.xlsx"))


def test_report_sheets(spark, tmp_path):
    heading = "".join(f"Heading {i}\n" for i in range(9))
    for sheet in ("Jan", "Feb"):
        (tmp_path / f"{sheet}.csv").write_text(f"{heading}E. Code,Name\n1,{sheet} person\n2,Heading 3\n")
    got = files.read_sheets(spark, [str(tmp_path / "Jan.csv"), str(tmp_path / "Feb.csv")], ["E_Code", "Name"])
    assert sorted((r.E_Code, r.Name, r.SourceSheet) for r in got.collect()) == [
        ("1", "Feb person", "Feb"), ("1", "Jan person", "Jan"), ("2", "Heading 3", "Feb"), ("2", "Heading 3", "Jan")]


def test_many_small_sheets_in_one_scan(spark, tmp_path):
    from strataflow.functions.temporal import parse_date
    from strataflow.functions.text import report_date_text
    for i in range(60):
        heading = "".join(f"Heading {k}\n" if k != 4 else f"Attendance Date: 0{1 + i % 9}-Feb-2026\n" for k in range(9))
        (tmp_path / f"s{i}.csv").write_text(f"{heading}E. Code,Name\n" + "".join(f"{k},p{i}\n" for k in range(3)))
    paths = str(tmp_path)
    got = files.read_sheets(spark, paths, ["E_Code", "Name"], dates=lambda line: parse_date(report_date_text(line))).collect()
    assert sorted((r.E_Code, r.Name, r.SourceSheet, str(r.report_date)) for r in got) == sorted(
        (str(k), f"p{i}", f"s{i}", f"2026-02-0{1 + i % 9}") for i in range(60) for k in range(3))


def test_served_dimension_follows(spark, lake):
    def versions(*rows):
        return spark.createDataFrame(rows, "key long, id string, v string, valid_from timestamp, valid_to timestamp, is_current int")
    from datetime import datetime
    one, two = datetime(2026, 1, 1), datetime(2026, 2, 1)
    serving = LakeServing(lake)
    serving.sync_dimension(versions((1, "a", "x", one, None, 1), (2, "b", "x", one, None, 1)), "dim", "id", "key")
    for _ in range(2):
        serving.sync_dimension(versions((3, "a", "y", two, None, 1), (2, "b", "x", one, None, 1), (4, "c", "z", two, None, 1)), "dim", "id", "key")
    got = sorted((r.key, r.v, r.is_current, r.valid_to) for r in lake.read("hr.serving.dim").collect())
    assert got == [(1, "x", 0, two), (2, "x", 1, None), (3, "y", 1, None), (4, "z", 1, None)]


def test_jdbc_statements():
    assert jdbc.insert_absent_sql("t", "t_staging", "k", ["k", "v"]) == (
        "INSERT INTO t (k, v) SELECT k, v FROM t_staging s WHERE NOT EXISTS (SELECT 1 FROM t t WHERE t.k = s.k)")
    expire, add = jdbc.sync_dimension_sql("dim", "dim_staging", "id", "key", ["key", "id"])
    assert expire.startswith("UPDATE dim SET is_current = 0") and "s.key <> dim.key" in expire and "NOT EXISTS" in add
    delete, insert = jdbc.replace_dates_sql("fact", "fact_staging", "work_date", ["a", "work_date"])
    assert delete == "DELETE FROM fact WHERE work_date IN (SELECT DISTINCT work_date FROM fact_staging)"
    assert insert == "INSERT INTO fact (a, work_date) SELECT a, work_date FROM fact_staging"


def test_dimension_keeps_old_history_untouched(spark, lake, tmp_path):
    def snap(*rows):
        from strataflow.functions.text import record_hash
        return spark.createDataFrame(list(rows), "id string, v string").withColumn("record_hash", record_hash(["v"]))

    def at(text):
        return F.lit(text).cast("timestamp")
    lake.apply_scd(snap(("a", "1"), ("b", "1")), "c.gold.dim", "id", at("2026-01-01"))
    lake.apply_scd(snap(("a", "2"), ("b", "1")), "c.gold.dim", "id", at("2026-02-01"))
    old = {p: p.stat().st_mtime_ns for p in (tmp_path / "lake/gold/dim/is_current=0").rglob("*.parquet")}
    lake.apply_scd(snap(("a", "3"), ("b", "1"), ("c", "1")), "c.gold.dim", "id", at("2026-03-01"))
    # Same time, another snapshot: the versions closed at that time are kept.
    lake.apply_scd(snap(("b", "2")), "c.gold.dim", "id", at("2026-03-01"))
    lake.apply_scd(snap(("b", "2")), "c.gold.dim", "id", at("2026-04-01"))
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in old.items()) and old
    got = sorted((r.id, r.v, r.is_current) for r in lake.read("c.gold.dim").collect())
    assert got == [("a", "1", 0), ("a", "2", 0), ("a", "3", 1), ("b", "1", 0), ("b", "2", 1), ("c", "1", 1)]
    lake.apply_scd(snap(("b", "2")), "c.gold.dim", "id", at("2026-05-01"), expire_missing=True)
    assert [r.id for r in lake.read("c.gold.dim").filter("is_current = 1").collect()] == ["b"]
    assert lake.read("c.gold.dim").count() == 6
