import json

from pyspark.sql import functions as F

from strataflow.functions import payload as P


def lines(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "raw_json string")


def test_three_nestings(spark):
    def shift(code, hours):
        return {"shift_code": code, "hours": hours}
    nested = {"result": [shift(70, "7.5"), shift(71, "8")]}
    df = lines(spark, nested, "{broken", {"response": {"result": [shift(55, "6")]}}, {"_airbyte_data": {"response": nested}})
    rows = P.explode_structs(df, P.locate(F.col("raw_json"), P.TIMESHEET_PATHS), "STRUCT<shift_code: INT, hours: STRING>")
    assert sorted((r.record.shift_code, r.record.hours) for r in rows.collect()) == [(55, "6"), (70, "7.5"), (70, "7.5"), (71, "8"), (71, "8")]


def test_polymorphic_payloads(spark):
    def person(i):
        return {"EmployeeID": f"E{i}", "FirstName": f"N{i}"}
    df = lines(spark, person(1), [person(2), person(3)], [{"k4": [person(4), person(40)]}, {"k5": person(5)}],
               {"response": {"result": {"k6": person(6), "k7": [person(7)], "status": 0}}}, "[broken", "null", "{}", "[]")
    texts = P.record_texts(P.locate(F.col("raw_json"), P.EMPLOYEE_PATHS, True), "EmployeeID")
    rows = P.explode_records(df, texts, P.struct_ddl(("EmployeeID", "FirstName")))
    got = sorted(r.record.EmployeeID for r in rows.collect() if r.record.EmployeeID)
    assert got == [f"E{i}" for i in range(1, 8)]


def test_map_records_leave_bookkeeping_out(spark):
    df = lines(spark, {"result": {"r1": {"a": "x"}, "status": 0, "message": "ok", "total_count": 1}})
    rows = P.explode_map_records(df, F.get_json_object("raw_json", "$.result"), "STRUCT<a: STRING>").collect()
    assert [(r.record_id, r.record.a) for r in rows] == [("r1", "x")]
    old_style = P.explode_map(df, F.get_json_object("raw_json", "$.result")).collect()
    assert [r.record_id for r in old_style] == ["r1"]


def test_first_map_value(spark):
    df = lines(spark, {"Days": {"2026-02-23": {"LeaveCount": "1.0"}, "2026-02-24": {"LeaveCount": "0.5"}}}, {"Days": {}})
    day = F.from_json("raw_json", "STRUCT<Days: MAP<STRING, STRUCT<LeaveCount: STRING>>>")["Days"]
    assert [r.d.LeaveCount if r.d else None for r in df.select(P.first_map_value(day).alias("d")).collect()] == ["1.0", None]


def test_payload_is_located_once_per_line(spark):
    df = lines(spark, {"EmployeeID": "E1"})
    texts = P.record_texts(P.locate(F.col("raw_json"), P.EMPLOYEE_PATHS, True), "EmployeeID")
    plan = df.select(F.explode(texts))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("$.response.result") == 1
