"""Files taken once, a served dimension after a stop, types from data."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strataflow.operators import rules
from strataflow.operators.inference import infer_types
from strataflow.operators.sets import name_issues
from strataflow.plans import intake
from strataflow.sources.lake import Lake, LakeServing


def test_files_are_taken_once(spark, lake, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, *lines):
        (folder / name).write_text("".join(f"{x}\n" for x in lines))

    def run():
        return sorted(os.path.basename(p) for p in intake.take_in(lake, str(folder), "hr.bronze.once", once=True))

    def lines():
        return sorted(r.raw_json for r in intake.bronze_lines(lake, "hr.bronze.once").collect())
    put("a.jsonl", 1, 2)
    put("note.txt", 9)
    assert run() == ["a.jsonl"] and run() == []
    put("b.jsonl", 3)
    assert run() == ["b.jsonl"] and lines() == ["1", "2", "3"]
    put("a.jsonl", 1, 2, 4)  # a changed file is another one
    assert run() == ["a.jsonl"] and lines() == ["1", "1", "2", "2", "3", "4"]
    # Stopped between ledger and bronze: the same files come with the next run, once.
    put("c.jsonl", 5)
    with monkeypatch.context() as m:
        m.setattr(Lake, "write_bronze", lambda *a, **k: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            run()
    put("d.jsonl", 6)
    assert run() == ["c.jsonl", "d.jsonl"] and run() == []
    assert lines() == ["1", "1", "2", "2", "3", "4", "5", "6"]


def test_a_stopped_sync_closes_a_version_once(spark, lake, monkeypatch):
    def versions(*rows):
        return spark.createDataFrame(rows, "key long, id string, v string, valid_from timestamp, valid_to timestamp, is_current int")
    one, two, three = (datetime(2026, m, 1) for m in (1, 2, 3))
    serving, write, calls = LakeServing(lake), Lake.replace_partitions, []
    serving.sync_dimension(versions((1, "a", "x", one, None, 1), (2, "b", "x", one, None, 1)), "dim", "id", "key")

    def stop_at_second(self, *args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("stopped")
        return write(self, *args, **kwargs)
    fresh = versions((3, "a", "y", two, None, 1), (2, "b", "x", one, None, 1), (4, "c", "z", two, None, 1))
    with monkeypatch.context() as m:
        m.setattr(Lake, "replace_partitions", stop_at_second)
        with pytest.raises(OSError):
            serving.sync_dimension(fresh, "dim", "id", "key")
    for _ in range(2):
        serving.sync_dimension(fresh, "dim", "id", "key")
    # Another key closed at the same time, in a later run, joins the versions closed before.
    serving.sync_dimension(versions((3, "a", "y", two, None, 1), (5, "b", "w", two, None, 1), (6, "c", "u", three, None, 1)), "dim", "id", "key")
    got = sorted((r.key, r.is_current, r.valid_to) for r in lake.read("hr.serving.dim").collect())
    assert got == [(1, 0, two), (2, 0, two), (3, 1, None), (4, 0, three), (5, 1, None), (6, 1, None)]


def test_types_from_data(spark):
    df = spark.createDataFrame([("1", "true", "1.5", "2026-01-31", "2026-01-31 10:00:00", "x", None, 12345678901), ("-20", "FALSE", "3", "2026-02-01", "2026-02-01", "1", None, 7),
                                (None, "true", "1e5", "2026-12-31", "2026-12-31T23:59:59.5", "", None, 8)],
                               "i string, b string, f string, d string, ts string, s string, n string, l bigint")
    rows = infer_types(df)
    got = {r["column"]: (r.data_type, r.present, r.max_length) for r in rows.collect()}
    assert got == {"i": ("int", 2, 3), "b": ("boolean", 3, 5), "f": ("double", 3, 3), "d": ("date", 3, 10), "ts": ("timestamp", 3, 21), "s": ("string", 3, 1),
                   "n": ("string", 0, None), "l": ("bigint", 3, 11)}
    plan = rules.rule_rows(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Python" not in plan
    config = rules.rules_of_rows(rules.rule_rows(rows))["validation_rules"]
    assert config["i"] == {"data_type": "int", "required": False, "check_corruption": True, "min_length": 3, "max_length": 3} and config["b"]["required"]
    assert {r.data_type for r in infer_types(df.limit(0)).collect()} == {"string"}


def test_names_in_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "c string")
    assert sorted(map(tuple, name_issues(df, "c", ["b", "z"]).collect())) == [("a", "unexpected_column"), ("z", "missing_column")]
    assert name_issues(df.limit(0), "c", ["z"]).collect()[0].issue == "missing_column"
