import os
import time

import pytest
from pyspark.sql import functions as F

from strataflow.operators.logs import error_labels, group_errors, number_error_groups, parse_error_log
from strataflow.operators.diagnose import error_report as build_report
from strataflow.operators.layout import release, scratch, shared_folder, stage
from strataflow.plans import error_report
from strataflow.sources.files import newest_file, read_log_lines

LOG = """[2026-02-23 09:00:00,001] 100 - ERROR - early.py - before any header
[2026-02-23 09:00:01,001] 0 - INFO - app - Logging for job: J (ID: 42)
[2026-02-23 09:00:02,001] 0 - INFO - app - Run 1: ID=900 | Life Cycle=X | Result=FAILED | Start=2026-02-23 08:00:00
  [2026-02-23 09:00:03,001] 100 - ERROR - load-x - [100 Error 1] Task [load] run_id=901 ERROR: Type: bad value
[2026-02-23 09:00:04,001] 101 - ERROR - step_y - plain - with dash
noise
[2026-02-23 09:00:05,001] 0 - INFO - app - Run 2: ID=910 | Start=2026-02-23 08:30:00
[2026-02-23 09:00:06,001] 100 - ERROR - load-x - Task [load] run_id=911 ERROR: Type: bad value
"""


def parsed(df):
    return [(r.runs, r.job_id, r.task_name, r.message) for r in df.collect()]


EXPECTED = [("", "42", "early.py", "before any header"), ("901_2026-02-23 08:00:00", "42", "load", "Type: bad value"),
            ("900_2026-02-23 08:00:00", "42", "step_y", "plain - with dash"), ("911_2026-02-23 08:30:00", "42", "load", "Type: bad value")]


def test_parse_small_file(spark, tmp_path):
    (tmp_path / "a.log").write_text(LOG)
    got = parse_error_log(read_log_lines(spark, str(tmp_path / "a.log")), block=F.col("block"))
    assert sorted(parsed(got)) == sorted(EXPECTED)


def test_parse_file_of_many_splits(spark, tmp_path):
    """Headers are carried over input splits; the job id at the top reaches the last line."""
    lines, want = ["x (ID: 7)"], []
    for i in range(3000):
        if i % 50 == 0:
            lines.append(f"Run 1: ID={i} | Start=2026-01-01 00:00:{i // 50:02d}")
        lines.append(f"[t] 1 - ERROR - s - e{i}")
        want.append((f"{i - i % 50}_2026-01-01 00:00:{i // 50:02d}", "7", "s", f"e{i}"))
    (tmp_path / "big.log").write_text("\n".join(lines))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        source = read_log_lines(spark, str(tmp_path / "big.log"))
        assert source.select("block").distinct().count() > 10
        assert sorted(parsed(parse_error_log(source, block=F.col("block")))) == sorted(want)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_log_without_job_id(spark):
    df = spark.createDataFrame([("a", 1, "[t] 1 - ERROR - s - m")], "source string, line_no bigint, line string")
    assert parsed(parse_error_log(df)) == [("", "UNKNOWN", "s", "m")]


def test_a_large_group_is_one_head_and_its_labels(spark):
    df = spark.range(1000).select(F.lit("j").alias("job_id"), F.lit("t").alias("task_name"), F.lit("m").alias("message"), F.concat(F.lit("r"), "id").alias("runs"))
    labels = error_labels(df.union(df))
    assert labels.count() == 1000 and [r.n_runs for r in group_errors(labels).collect()] == [1000]
    answers = {c: F.lit(None).cast("string") for c in ("error_type", "severity_score", "diagnosis")}
    report = build_report(group_errors(labels).withColumns(answers), labels)
    assert report.where("section = 2 and line <> 1").count() == 2 and report.where("line = 1").select("text").distinct().count() == 1000


def test_report_numbers_do_not_depend_on_blocks(spark):
    rows = [("j", f"task {'x' * 20}{i % 7}", f"Task failed with {i:03d}") for i in range(60)]
    labels = spark.createDataFrame([(*r, "run") for r in rows], "job_id string, task_name string, message string, runs string")
    answers = {c: F.lit(None).cast("string") for c in ("error_type", "severity_score", "diagnosis")}
    seen = []
    for parts in ("1", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            report = build_report(group_errors(labels).withColumns(answers), labels)
            seen.append(sorted(map(tuple, report.collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen[0] == seen[1] and [r[2] for r in seen[0] if r[1] == 2 and r[3] == 0] == list(range(1, 61))


def test_staged_tables_are_released(spark):
    release(spark)
    labels = spark.createDataFrame([("j", "t", "m", "r")], "job_id string, task_name string, message string, runs string")
    answers = {c: F.lit(None).cast("string") for c in ("error_type", "severity_score", "diagnosis")}
    build_report(group_errors(labels).withColumns(answers), labels).collect()
    assert release(spark) == 2 and release(spark) == 0


def test_a_scope_deletes_its_own_tables_only(spark):
    release(spark)
    outside = stage(spark.range(3), "outside")
    with pytest.raises(ValueError), scratch(spark):
        with scratch(spark):
            inner = stage(spark.range(5), "inner")
        outer = stage(spark.range(4), "outer")
        raise ValueError
    folder = shared_folder(spark).removeprefix("file://") + "/staged"
    left = [n for n in os.listdir(folder) if n.startswith(("outside-", "inner-", "outer-")) and not n.endswith(".crc")]
    assert len(left) == 1 and outside.count() == 3 and inner is not outer and release(spark) == 1


def test_numbering(spark):
    rows = [(1, 10, "k1", "Task a failed"), (1, 11, "k2", "boom\r\nTask a again"), (1, 12, "k2", "boom"), (1, 13, "k3", None), (1, 14, "k1", "Task a"), (2, 15, "z", "q")]
    got = number_error_groups(spark.createDataFrame(rows, "job_id int, ord int, task_key string, error_text string"), block_rows=2)
    assert sorted((r.job_id, r.ord, r.source, r.group_no, r.error_index, r.message) for r in got.collect()) == [
        (1, 10, "a", 100, 1, "Task a failed"), (1, 11, "a", 100, 2, "boom Task a again"), (1, 12, "k2", 101, 1, "boom"), (1, 14, "a", 100, 3, "Task a"), (2, 15, "z", 100, 1, "q")]


def test_report_from_the_newest_file(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "old.log").write_text("[t] 1 - ERROR - s - old")
    os.utime(logs / "old.log", (time.time() - 999, time.time() - 999))
    (logs / "new.log").write_text(LOG)
    assert newest_file(spark, str(logs)).endswith("new.log")
    answers = spark.createDataFrame([("load", "Type: bad value", "ERROR_TYPE: TYPE_ERROR", "SUMMARY: s\nSEVERITY: High")],
                                    "task_name string, message string, kind string, detail string")
    path = error_report.run(spark, str(logs), answers.withColumnRenamed("kind", "response"), answers.withColumnRenamed("detail", "response"), str(tmp_path / "out"))
    assert path.endswith("new.log")
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert "- TYPE_ERROR: 1" in text and "- OTHER_ERROR: 2" in text and "Error Group 2 [TYPE_ERROR - High]" in text
    assert "Run: 901_2026-02-23 08:00:00\nRun: 911_2026-02-23 08:30:00" in text


def test_numbering_of_sparse_orders_and_null_jobs(spark):
    """Orders with gaps of millions, blocks of one row, a job without an id: as a plain count per job and source."""
    import random
    rnd = random.Random(5)
    orders = rnd.sample(range(10**12), 400)
    rows = [(rnd.choice([None, 1, 1, 1, 2]), o, rnd.choice("abc"), "boom") for o in orders]
    got = number_error_groups(spark.createDataFrame(rows, "job_id int, ord long, task_key string, error_text string"), block_rows=1 << 10).collect()
    seen, groups, want = {}, {}, []
    for job, at, source, _ in sorted(rows, key=lambda r: r[1]):
        number = groups.setdefault(job, {}).setdefault(source, 100 + len(groups[job]))
        seen[job, source] = seen.get((job, source), 0) + 1
        want.append((at, job, source, number, seen[job, source]))
    assert sorted((r.ord, r.job_id, r.source, r.group_no, r.error_index) for r in got) == want
