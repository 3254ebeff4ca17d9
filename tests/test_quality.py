import json

import pytest
from pyspark.sql import functions as F

from strataflow.operators import checks, metrics, rules
from strataflow.operators.expectations import Expectations
from strataflow.plans import quality


@pytest.fixture
def gold(spark):
    return spark.createDataFrame([(1, "2026-02-23", 8.0, True), (2, "2026-02-23", 7.5, True), (3, None, 0.0, False)],
                                 "dim_employee_key int, work_date string, hours_worked double, is_present boolean")


def test_expectations_pass_and_fail(gold):
    good = (Expectations(gold).column_to_exist("dim_employee_key").column_values_not_null("dim_employee_key").column_values_unique("dim_employee_key")
            .column_values_in_set("is_present", [True, False]).row_count_between(1, 100))
    assert good.get_report()["passed"]
    good.assert_all()
    bad = Expectations(gold).column_values_not_null("work_date").column_values_unique("work_date").column_values_unique("gone").column_to_exist("gone")
    report = bad.get_report()
    assert not report["passed"] and [a["details"] for a in report["assertions"]] == ["Null count: 1", "Total: 3, Distinct: 2", "", ""]
    with pytest.raises(AssertionError, match="work_date"):
        bad.assert_all()


def test_null_rows_pass_the_set_check(gold):
    assert Expectations(gold).column_values_in_set("work_date", ["2026-02-23"]).get_report()["passed"]


def test_expectations_run_as_one_aggregation(gold):
    report = Expectations(gold).column_values_not_null("work_date").row_count_between(0, 9).report()
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1


MASKS = {
    "ann@mail.org": "a****@mail.org", "a.b+c@x.de, d@y.org\nq@z.com": "a****@x.de, d@y.org\nq****@z.com", "+491234567890": "+49****90",
    "1234567812345678": "12****78", "4111 1111 1111 12345": "4111 1111 1111 *2345", "123-45-6789": "***-**-6789", "K1234567": "K****67",
    "DE89ABCDEFGHIJKLM": "DE89****JKLM", "10.0.12.7": "***.***.***.7", "2001:db8:0:0:0:0:0:1f": "****:****:****:****:1f",
    "a:b:c:d:e:f:a:b": "****:****:****:****:b", "1990-01-02": "****-**-**", "plain": "plain", "": "", None: None,
}


def test_masking(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(MASKS)], "id int, v string")
    got = [r.v for r in checks.mask_table(df, ["v"]).orderBy("id").collect()]
    assert got == list(MASKS.values())
    found = checks.find_issues(df, checks.pii_checks(df, ["v"]), "id").collect()
    assert {r.value: r.masked_value for r in found} == {k: v for k, v in MASKS.items() if k != v}


@pytest.fixture
def people(spark):
    return spark.createDataFrame([
        (1, "John", "john@x.org", "3"), (2, None, "NaN ", "x"), (3, "Zoë", "!!??a", "4"), (4, "John", None, None)],
        "id int, name string, email string, age string")


def test_validate_table(spark, people):
    found = checks.validate_table(people, {"expected_schema": {"id": "bigint", "age": "int", "name": "string"}, "expected_columns": ["id", "name", "age", "city"],
                                           "nullable": {"id": False, "name": False, "email": False}}, "id", {"name": "[A-Z][a-z]+"})
    got = sorted((r.row_id or "", r.column, r.issue) for r in found.collect())
    assert got == sorted([("", "city", "missing_column"), ("", "email", "unexpected_column"), ("2", "age", "dtype_mismatch"), ("2", "name", "null_violation"),
                          ("4", "email", "null_violation"), ("2", "email", "null_violation"), ("3", "name", "corrupted_non_ascii"),
                          ("3", "email", "corrupted_special_chars"), ("3", "name", "pattern_mismatch"), ("1", "email", "pii_detected")])
    metric = {r.column: r for r in metrics.quality_metrics(people, metrics.flagged_rows(found)).collect()}
    assert (metric["name"].completeness_pct, metric["name"].uniqueness_pct, metric["name"].validity_pct) == (75.0, 50.0, 50.0)
    assert metric["id"].validity_pct == 100.0


def test_metrics_of_an_empty_table(spark, people):
    empty = people.limit(0)
    got = metrics.quality_metrics(empty, metrics.flagged_rows(checks.find_issues(empty, [], "id"))).collect()
    assert len(got) == 4 and all((r.completeness_pct, r.uniqueness_pct, r.validity_pct) == (0.0, 0.0, 0.0) for r in got)


def test_profile_counts_long_and_signed_zero_values(spark):
    long = "x" * 500
    df = spark.createDataFrame([(long, 0.0, [1]), (long + "y", -0.0, [1]), (long, None, [2])], "t string, d double, a array<int>")
    got = {r.column: (r.total_rows, r.non_null, r.distinct_values) for r in metrics.column_profile(df).collect()}
    assert got == {"t": (3, 3, 2), "d": (3, 2, 1), "a": (3, 3, 2)}
    approx = {r.column: r.distinct_values for r in metrics.column_profile(df, approximate=True).collect()}
    assert approx == {"t": 2, "d": 1, "a": 2}


@pytest.mark.parametrize("kind, good, bad", [
    ("integer", ["1", "-12"], ["1-2", "1.5", "x"]), ("float", ["1", "1.5", ".5", "1e5", "nan"], ["1.5f", "x", ""]), ("boolean", ["Yes", "0", "TRUE"], ["maybe"]),
    ("date", ["2024-01-02", "02-Jan-2024", "2024-01-02 03:04:05"], ["soon"]), ("email", ["a@b.co"], ["a@b", "x a@b.co"]),
    ("phone", ["+49 (123) 456-7890", "1234567890"], ["12345", "12345678a0", "123.456.7890", "1" * 16]), ("url", ["http://x", "https://y"], ["x.com", "ftp://x"]),
    ("latlong", ["1.5, -2", "1,2"], ["1;2", "a,b"]), ("string", [""], []), ("other", ["x"], [])])
def test_semantic_types(spark, kind, good, bad):
    from strataflow.functions.semantic import fits_semantic_type
    df = spark.createDataFrame([(v, True) for v in good] + [(v, False) for v in bad] + [(None, False)], "v string, want boolean")
    assert all(r.got == r.want for r in df.select("want", fits_semantic_type(F.col("v"), kind).alias("got")).collect())


def test_custom_type_rules(spark):
    from strataflow.functions.semantic import fits_semantic_type
    custom = {"phone_formats": {"patterns": [r"\+?[1-9][0-9]{9,14}"]}, "url_validation": {"accepted_domains": [".com"]},
              "coordinate_validation": {"latitude_range": [-90, 90], "longitude_range": [-180, 180]}}
    for kind, value, want in (("phone", "0123456789", False), ("phone", "+4912345678", True), ("url", "shop.com", True), ("latlong", "90.0,-180", True),
                              ("latlong", "91,0", False)):
        got = spark.range(1).select(fits_semantic_type(F.lit(value), kind, custom).alias("g")).first().g
        assert got == want, (kind, value)


CONFIG = {"validation_rules": {"name": {"data_type": "string", "required": True, "min_length": 3, "allowed_values": ["Anna", "Bob"]},
                               "n": {"data_type": "integer", "min_value": 1, "max_value": 5}},
          "fix_strategies": {"name": {"required_missing": "Unknown"}, "default": {"min_length_violation": "short", "invalid_integer": "0"}}}


def test_repair_and_log(spark):
    df = spark.createDataFrame([(1, None, "2"), (2, "Al", "x"), (3, "Bob", "9"), (4, "Anna", None)], "id int, name string, n string")
    result = quality.repair_table(df, CONFIG, "id")
    log = sorted((r.row_id, r.column, r.issue, r.old_value, r.new_value) for r in result["log"].collect() if r.row_id != "1")
    assert log == [("2", "n", "invalid_integer", "x", "0"), ("2", "name", "invalid_value", "short", "N/A"),
                   ("2", "name", "min_length_violation", "Al", "short"), ("3", "n", "max_value_violation", "9", "0")]
    fixed = {r.id: (r.name, r.n) for r in result["fixed"].collect()}
    assert fixed == {1: ("Unknown", "2"), 2: ("N/A", "0"), 3: ("Bob", "0"), 4: ("Anna", None)}
    assert result["outcome"].first().outcome == "5 issues were fixed across 2 columns."
    closed = quality.repair_table(df, CONFIG, "id", {"n": {"max_value_violation": False}})
    assert {r.id: (r.name, r.n) for r in closed["fixed"].collect()}[3] == ("Bob", "9") and closed["log"].count() == 0
    clean = quality.repair_table(df.filter("id = 4"), CONFIG, "id")
    assert clean["outcome"].first().outcome == "No issues detected. Data is clean."


def test_rule_synthesis(spark):
    df = spark.createDataFrame([("a", "12345"), ("bbbb", None)], "x string, y string")
    got = rules.synthesize_rules(df, {"x": "string", "y": "phone"})
    assert got["validation_rules"]["x"]["max_length"] == 4 and got["validation_rules"]["y"]["max_length"] == 5
    assert rules.synthesize_rules(df, {"x": "string"}, sample_rows=1, order=["x"])["validation_rules"]["x"]["max_length"] == 1


def test_repair_file(spark, tmp_path):
    (tmp_path / "in.csv").write_text("name,n\nAnna,3\n,\nAl,7\n")
    result = quality.repair_file(spark, str(tmp_path / "in.csv"), CONFIG, str(tmp_path / "out"), schema="name string, n string")
    assert result["fixed"].count() == 2
    out = spark.read.option("header", True).csv(str(tmp_path / "out" / "cleaned.csv")).orderBy("name").collect()
    assert [(r.name, r.n) for r in out] == [("Anna", "3"), ("N/A", "0")]


def test_catalog_run(spark, people, tmp_path):
    meta = [{"name": "id", "type_name": "bigint", "nullable": False}, {"name": "name", "type_name": "string", "nullable": False, "pii": True},
            {"name": "age", "type_name": "int", "nullable": True}, {"name": "email", "type_name": "string", "nullable": True}]
    tables = spark.createDataFrame([("t1", "main.people", json.dumps(meta), 10, 5), ("t2", "main.people", json.dumps(meta), 10, 20)],
                                   "table_id string, full_name string, metadata string, updated_at bigint, last_dq_checked bigint")
    stamped = quality.check_tables(spark, tables, str(tmp_path), 99, load=lambda name: people, row_ids={"main.people": "id"})
    assert {r.table_id: r.last_dq_checked for r in stamped.collect()} == {"t1": 99, "t2": 20}
    issues = spark.read.parquet(str(tmp_path / "issues"))
    assert {r.table_id for r in issues.select("table_id").distinct().collect()} == {"t1"}
    report = spark.read.json(str(tmp_path / "report"))
    assert report.filter("item = 'total_issues'").first().number == issues.count()


def test_a_broken_table_stops_no_other(spark, people, tmp_path):
    meta = json.dumps([{"name": "id", "type_name": "bigint", "nullable": False}, {"name": "name", "type_name": "string", "nullable": False}])
    listing = [(k, f"main.t{k}", meta if k != 5 else None, 10, None) for k in range(8)]
    tables = spark.createDataFrame(listing, "table_id long, full_name string, metadata string, updated_at bigint, last_dq_checked bigint")
    pools = {}

    def load(name):
        if name == "main.t3":
            raise LookupError("no such table")
        if name == "main.t4":  # read without error, broken once it is computed
            return people.withColumn("name", F.raise_error(F.lit("bad file")).cast("string"))
        pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        return people

    stamped = quality.check_tables(spark, tables, str(tmp_path), 99, load=load, row_ids={f"main.t{k}": "id" for k in range(8)}, parallel=3)
    assert {r.table_id for r in stamped.where("last_dq_checked = 99").collect()} == {0, 1, 2, 5, 6, 7}
    outcome = {r.table_id: r for r in spark.read.json(str(tmp_path / "outcome")).collect()}
    assert [k for k, r in sorted(outcome.items()) if r.state == "failed"] == [3, 4] and outcome[3].message == "no such table"
    counts = {r.table_id: r["count"] for r in spark.read.parquet(str(tmp_path / "issues")).groupBy("table_id").count().collect()}
    assert all(outcome[k].n_issues == counts[k] for k in (0, 1, 2, 5, 6, 7))
    assert pools["main.t0"] == "quality-0" and pools["main.t7"] == "quality-7"
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_a_run_without_due_tables(spark, tmp_path):
    tables = spark.createDataFrame([("t", "main.t", None, 1, 5)], "table_id string, full_name string, metadata string, updated_at bigint, last_dq_checked bigint")
    assert [r.last_dq_checked for r in quality.check_tables(spark, tables, str(tmp_path), 99).collect()] == [5]


def report_rows(df):
    return sorted((r.section, r.column or "", r.item, r.number) for r in df.collect())


def test_report_of_checks_equals_the_report_of_issues(spark):
    df = spark.createDataFrame([(1, "é", None), (2, "###", 1.0), (3, None, 0.0), (4, "plain", -0.0), (5, "é#%&*", 2.0)], "id int, t string, x double")
    found = checks.corruption_checks(df) + checks.null_checks(df, {"t": False})
    got = report_rows(metrics.checked_report(df, found))
    assert got == report_rows(metrics.quality_report(df, checks.find_issues(df, found, "id")))
    assert ("summary", "", "total_rows", 5.0) in got and ("issues_by_column", "t", "null_violation", 1.0) in got
    assert ("quality_metrics", "x", "uniqueness_pct", 60.0) in got


def test_report_of_an_empty_table_and_of_no_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a")], "id int, t string")
    for found in ([], checks.corruption_checks(df)):
        empty = report_rows(metrics.checked_report(df.where("false"), found))
        assert [r for r in empty if r[0] == "summary"] == [("summary", "", "total_issues", 0.0), ("summary", "", "total_rows", 0.0)] and len(empty) == 8
        assert ("quality_metrics", "t", "uniqueness_pct", 50.0) in report_rows(metrics.checked_report(df, found))
    with pytest.raises(ValueError):
        metrics.checked_report(df, checks.corruption_checks(df, ["t"]), ["id"])


def test_report_of_checks_reads_its_table_once(spark, tmp_path):
    spark.range(50).select("id", F.col("id").cast("string").alias("t")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = metrics.checked_report(df, checks.corruption_checks(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_first_issues_hold_few_rows(spark, tmp_path):
    from strataflow.workloads import REGISTRY

    spark.range(1, 41).selectExpr("id AS c_custkey", "concat('Customer#', id) AS c_name", "id % 25 AS c_nationkey",
                                  "IF(id = 7, NULL, 'BUILDING') AS c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    got = REGISTRY["pii_first_issues"](spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan and "Sort " not in plan
    found = {}
    for row in got.collect():
        found.setdefault(row.column, []).append(int(row.row_id))
    assert sorted(found["email"]) == [1, 2, 3, 4, 5] and all(len(ids) == 5 for ids in found.values())


def test_first_issues_order(spark):
    df = spark.createDataFrame([("10", "a@b.co", None), ("9", "c@d.co", "é"), ("x", "e@f.co", None), (None, "g@h.co", None), ("9", "ü@i.co", None)],
                               "id string, mail string, name string")
    every = checks.pii_checks(df, ["mail"]) + checks.corruption_checks(df, ["mail", "name"])
    got = [(r["column"], r.row_id, r.issue) for r in checks.first_issues(df, every, "id", 3).collect()]
    assert [g for g in got if g[0] == "name"] == [("name", "9", "corrupted_non_ascii")]
    assert sorted(g[1:] for g in got if g[0] == "mail") == [("10", "pii_detected"), ("9", "corrupted_non_ascii"), ("9", "pii_detected")]
    assert checks.first_issues(df, []).collect() == []
