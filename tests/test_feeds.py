"""The five feeds end to end on files, run twice."""

import json

import pytest
from pyspark.sql import functions as F

from strataflow.plans import attendance, biometric, employee, leave, timesheet
from strataflow.sources.lake import LakeServing


def write(folder, name, docs):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(d) + "\n" for d in docs))


@pytest.fixture
def staffed(spark, lake, tmp_path):
    """A lake with two employees and a date dimension."""
    write(tmp_path / "emp", "a.jsonl", [{"response": {"result": {"1": {"EmployeeID": "7", "FirstName": " John ", "LastName": "Doe", "EmailID": "john@x.org",
          "Dateofjoining": "01-Feb-2020", "AddedTime": "05-Mar-2024 10:11:12", "ModifiedTime": "1709633472000", "Department": ""}}}},
          [{"EmployeeID": "E8", "FirstName": "Ann", "EmailID": "ann@x.org"}]])
    write(tmp_path / "emp", "b_failed_parse.jsonl", [{"EmployeeID": "9"}])
    employee.run(lake, str(tmp_path / "emp"), as_of=F.lit("2026-01-01").cast("timestamp"))
    dates = spark.sql("select cast(date_format(d,'yyyyMMdd') as int) dim_date_key, d full_date from "
                      "(select explode(sequence(date'2026-02-20', date'2026-02-28')) d)")
    return lake, dates, tmp_path


def test_employee_dimension(staffed):
    lake, _, tmp = staffed
    employee.run(lake, str(tmp / "emp"), as_of=F.lit("2026-01-02").cast("timestamp"))
    dim = {r.employee_id: r for r in lake.read("hr.gold.dim_employee").collect()}
    assert set(dim) == {"7", "E8"}
    john = dim["7"]
    assert john.full_name == "John Doe" and john.department is None and str(john.date_of_joining) == "2020-02-01"
    assert john.is_current == 1 and john.valid_to is None and john.is_billable == 0
    assert john.added_time == john.modified_time
    write(tmp / "emp", "c.jsonl", [{"EmployeeID": "7", "FirstName": "John", "LastName": "Smith"}])
    employee.run(lake, str(tmp / "emp"), as_of=F.lit("2026-02-01").cast("timestamp"))
    versions = lake.read("hr.gold.dim_employee").filter("employee_id = '7'").orderBy("valid_from").collect()
    assert [(v.last_name, v.is_current) for v in versions] == [("Doe", 0), ("Smith", 1)]
    parts = {p.name for p in (tmp / "lake" / "gold" / "dim_employee").glob("is_current=*")}
    assert parts == {"is_current=0", "is_current=1"}


def test_archive_and_no_files(staffed):
    lake, dates, tmp = staffed
    assert employee.run(lake, str(tmp / "emp"), archive_to=str(tmp / "done")) is True
    assert (tmp / "done" / "a.jsonl").exists() and not (tmp / "emp" / "a.jsonl").exists()
    assert (tmp / "emp" / "b_failed_parse.jsonl").exists()
    assert employee.run(lake, str(tmp / "emp")) is False


def test_attendance(spark, staffed):
    lake, dates, tmp = staffed
    write(tmp / "att", "a.jsonl", [
        {"_airbyte_ab_id": "x", "_airbyte_data": {"response": {"result": [
            {"Date": "23-Feb-2026", "employee_id": "7", "working_hour": "08:30", "FirstIn": "23-Feb-2026 09:00 AM", "ercno": "A1"},
            {"Date": "24-Feb-2026", "employee_id": "E8", "working_hour": "bad"}, {"Date": "soon", "employee_id": "7"}]}}},
        {"_airbyte_data": [{"Date": "2026-02-25", "employee_id": "unknown"}]}, "noise"])
    serving = LakeServing(lake)
    for _ in range(2):
        attendance.run(lake, str(tmp / "att"), dates, serving=serving)
        fact = lake.read("hr.gold.fact_attendance")
        got = sorted((r.dim_date_key, r.work_minutes, str(r.first_in_ts), r.ercno) for r in fact.collect())
        assert got == [(20260223, 510, "2026-02-23 09:00:00", None), (20260224, None, "None", None)]
        assert lake.read("hr.serving.fact_attendance").count() == 2
    assert lake.read("hr.bronze.attendance_raw").count() == 6


def test_leave(staffed):
    lake, dates, tmp = staffed
    write(tmp / "lv", "a.jsonl", [{"response": {"result": {"r1": {"EmployeeId": "7", "Zoho.ID": 11, "From": "23-Feb-2026", "To": "2026-02-24", "Reason": "x", "Days": {
        "2026-02-23": {"StartTime": "09:00:00", "EndTime": "2026-02-23 18:00:00", "LeaveCount": "1.0"}, "2026-02-24": {"LeaveCount": "0.5"}}},
        "status": 0, "r2": {"EmployeeId": "7", "Zoho.ID": 12, "From": "never"}}}}])
    for _ in range(2):
        leave.run(lake, str(tmp / "lv"), dates, serving=LakeServing(lake))
    row = lake.read("hr.serving.fact_leave").collect()
    assert len(row) == 1 and (row[0].source_leave_id, row[0].leave_start_time, row[0].leave_end_time, str(row[0].leave_count)) == (11, "09:00:00", "18:00:00", "1.0")


def test_timesheet(staffed):
    lake, dates, tmp = staffed
    def log(**k):
        return json.dumps({"timelogId": "101", "workDate": "2026-02-23", "employeeMailId": "john@x.org", "hoursInMins": "480", "isEditAllowed": True, **k})
    write(tmp / "ts", "a.jsonl", [{"response": {"result": [log(), log(timelogId="99999999999"), log(timelogId="5", employeeMailId="who@x.org"), log(workDate="?")]}}])
    for _ in range(2):
        timesheet.run(lake, str(tmp / "ts"), dates, serving=LakeServing(lake))
    got = sorted((r.timelog_id, r.source_log_id, r.minutes_int, r.is_edit_allowed, r.dim_date_key) for r in lake.read("hr.serving.fact_timesheet").collect())
    assert got == [("101", 101, 480, 1, 20260223), ("99999999999", None, 480, 1, 20260223)]


def test_biometric(spark, staffed):
    lake, dates, _ = staffed
    def report(dur):
        return spark.createDataFrame([("7", "John", "GS", "09:00", "18:00", dur, None, dur, "P"), ("8x", "Bad", "GS", "", "", "", "", "", "A")],
                                     "`E. Code` string, EmpName string, Shift string, `A.InTime` string, `A. OutTime` string, `Work Dur.` string, OT string, `Tot. Dur.` string, Status string")
    day = F.to_date(F.lit("2026-02-23"))
    for i, dur in enumerate(("08:00", "08:15", "08:15")):
        biometric.run(lake, report(dur), day, dates, as_of=F.lit(f"2026-02-24 00:0{i}:00").cast("timestamp"), serving=LakeServing(lake))
    got = [(r.source_bio_id, r.work_minutes, r.ot_minutes, r.dim_date_key) for r in lake.read("hr.serving.fact_attendance_biometric").collect()]
    assert got == [("7", 495, None, 20260223)]
    assert lake.read("hr.bronze.biometric_raw").count() == 6 and lake.read("hr.silver.biometric_cleaned").count() == 1


def test_biometric_folder(spark, staffed, tmp_path):
    lake, dates, _ = staffed
    columns = ["E_Code", "EmpName", "Shift", "A_InTime", "A_OutTime", "Work_Dur", "OT", "Tot_Dur", "Status"]
    folder, done = tmp_path / "reports", tmp_path / "done"
    folder.mkdir()
    for day, dur in (("23", "08:00"), ("24", "07:30")):
        heading = "".join(f"Heading {k}\n" if k != 2 else f"Attendance Date: {day}-Feb-2026\n" for k in range(9))
        (folder / f"r{day}.csv").write_text(heading + ",".join(columns) + f"\n7,John,GS,09:00,18:00,{dur},,{dur},P\n")
    assert biometric.run_folder(lake, str(folder), columns, dates, archive_to=str(done))
    assert not biometric.run_folder(lake, str(folder), columns, dates)
    bronze = lake.read("hr.bronze.biometric_raw", evolving=True).where("SourceSheet is not null")
    assert sorted((r.SourceSheet, str(r.ingest_work_date)) for r in bronze.collect()) == [("r23", "2026-02-23"), ("r24", "2026-02-24")]
    assert lake.read("hr.silver.biometric_cleaned").where("work_date = '2026-02-24'").first().work_minutes == 450
