import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataflow.functions import casts, temporal, text


def values(spark, kind, rows, make):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r.o for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_dates_of_both_formats_and_bad_ones(spark):
    got = values(spark, "string", ["23-Feb-2026", " 2026-02-24 ", "2026-2-4", "31-Feb-2026", "02/03/2026", "", None], temporal.parse_date)
    assert got == [dt.date(2026, 2, 23), dt.date(2026, 2, 24)] + [None] * 5


def test_timestamps_of_all_formats(spark):
    rows = ["23-Feb-2026 09:05 PM", "2026-02-23 21:05:06", "2026-02-23T21:05:06", "2026-02-23", None]
    got = values(spark, "string", rows, lambda c: F.date_format(temporal.parse_timestamp(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2026-02-23 21:05:00", "2026-02-23 21:05:06", "2026-02-23 21:05:06", None, None]


def test_every_format_matches_its_own_shape(spark):
    moment = F.lit("2026-11-05 13:04:09").cast("timestamp")
    for fmt in temporal.DATE_FORMATS + temporal.TIMESTAMP_FORMATS + temporal.TIME_OF_DAY_FORMATS:
        assert spark.range(1).select(F.date_format(moment, fmt).rlike(temporal.format_shape(fmt)).alias("ok")).first().ok, fmt


@pytest.mark.parametrize("clock, minutes", [("08:30", 510), ("00:15", 15), ("10:05", 605), ("8", None), ("x:10", None), ("", None), (None, None)])
def test_clock_to_minutes(spark, clock, minutes):
    assert values(spark, "string", [clock], temporal.clock_to_minutes) == [minutes]


def test_epoch_or_text(spark):
    got = values(spark, "string", ["05-Mar-2024 10:11:12", "1709633472000", "soon", None],
                 lambda c: F.date_format(temporal.epoch_or_text(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-03-05 10:11:12", "2024-03-05 10:11:12", None, None]


def test_casts_give_null_instead_of_failing(spark):
    rows = ["12", " 12 ", "-3", "12.5", "1_000", "99999999999", "abc", "", None]
    assert values(spark, "string", rows, casts.to_int) == [12, 12, -3, None, None, None, None, None, None]
    assert values(spark, "string", ["99999999999", "9" * 30], casts.to_long) == [99999999999, None]
    assert values(spark, "string", ["1e3", ".5", "nan", "1.5f", "x"], lambda c: casts.to_double(c).cast("string")) == ["1000.0", "0.5", "NaN", None, None]
    assert values(spark, "string", ["0.5", "12345", "x"], lambda c: casts.to_decimal(c, 4, 1).cast("string")) == ["0.5", None, None]
    assert values(spark, "string", ["1", "0", "true", "FALSE", "maybe", None], casts.to_flag) == [1, 0, 1, 0, None, None]


@pytest.mark.parametrize("raw, clean", [("E. Code", "E_Code"), (" A.InTime ", "A_InTime"), ("Tot.  Dur.", "Tot_Dur"), ("Name", "Name"),
                                        ("In-Time (24h)", "In-Time_(24h)"), ("__x__", "x")])
def test_header_names(raw, clean):
    assert text.header_name(raw) == clean


def test_labelled_values(spark):
    body = "  \nERROR_TYPE: A\nREASON: first: second\nERROR_TYPE:  B \n"
    assert values(spark, "string", [body], lambda c: text.labelled_value(c, "ERROR_TYPE", "X")) == ["B"]
    assert values(spark, "string", [body], lambda c: text.labelled_value(c, "REASON", "X")) == ["first: second"]
    assert values(spark, "string", [body, None], lambda c: text.labelled_value(c, "CONFIDENCE", "Low")) == ["Low", "Low"]


def test_record_hash_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    strict = {r.h for r in df.select(text.record_hash(["x", "y", "z"]).alias("h")).collect()}
    parity = {r.h for r in df.select(text.record_hash(["x", "y", "z"], parity=True).alias("h")).collect()}
    assert len(strict) == 2 and len(parity) == 1


def test_file_safe_names(spark):
    assert values(spark, "string", ["a b/c:d-e_f.g", "é"], text.file_safe) == ["a_b_c_d-e_f.g", "é"]
