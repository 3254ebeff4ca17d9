"""Cleaning, parsing and latest-row queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.casts import to_decimal, to_flag, to_int, to_long, to_tiny
from ..functions.temporal import clock_to_minutes, duration_millis, epoch_or_text, parse_date, parse_timestamp, previous_day, time_of_day
from ..functions.text import file_safe, full_name, record_hash, report_date_text
from ..operators.blocks import integer_block, row_index
from ..operators.cleaning import (add_constants, blank_strings_to_null, hours_and_overtime, in_batch_dates, keep_existing,
                                  rename_select, require, resolve_alias, sanitise_headers)
from ..operators.latest import keep_latest
from ..operators.sets import union_all
from .registry import query

STAMP = "yyyy-MM-dd HH:mm:ss"


def stamp(c):
    return F.date_format(c, STAMP)


@query("trim_empty_to_null", """
    SELECT p_partkey, p_name AS name, CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_type END AS kind,
           CASE WHEN p_size < 10 THEN NULL ELSE p_brand END AS brand, p_size
    FROM part
""")
def trim_empty_to_null(t):
    raw = t.part.select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("name"),
                        F.when(F.col("p_type") == "ECONOMY", "   ").otherwise(F.col("p_type")).alias("kind"),
                        F.when(F.col("p_size") < 10, "").otherwise(F.concat("p_brand", F.lit(" "))).alias("brand"), "p_size")
    return blank_strings_to_null(raw)


@query("case_insensitive_alias", """
    SELECT CAST(s_suppkey AS INTEGER) AS employee_id, s_name AS person FROM supplier
""")
def case_insensitive_alias(t):
    report = t.supplier.toDF("E. Code ", "EmpName", "Nation Key", "Acct..Bal")
    clean = sanitise_headers(report)
    return clean.select(to_int(resolve_alias(clean, "e_code", "ecode")).alias("employee_id"),
                        resolve_alias(clean, "name", "empname").alias("person"))


@query("rename_and_keep_existing", """
    SELECT c_custkey AS id, c_name AS name, 0 AS is_billable, CAST(NULL AS INTEGER) AS source_row_id FROM customer
""")
def rename_and_keep_existing(t):
    kept = keep_existing(t.customer, ("c_custkey", "c_missing", "c_name"))
    return add_constants(rename_select(kept, {"c_custkey": "id", "c_name": "name"}), {"is_billable": 0},
                         {"source_row_id": "int"})


@query("required_keys", """
    SELECT d.doc_id, quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE quality IS NOT NULL
""")
def required_keys(t):
    return require(t.documents.join(t.labels, "doc_id", "left").select("doc_id", "quality"), "quality")


@query("multi_format_dates", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS parsed FROM orders
""")
def multi_format_dates(t):
    status = F.col("o_orderstatus")
    raw = F.when(status == "F", F.date_format("o_orderdate", " dd-MMM-yyyy ")) \
        .when(status == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return t.orders.select("o_orderkey", parse_date(raw).cast("string").alias("parsed"))


@query("multi_format_timestamps", """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL
        WHEN 'click' THEN strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S')
        ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed
    FROM events
""")
def multi_format_timestamps(t):
    kind = F.col("event_type")
    raw = F.when(kind == "click", F.date_format("ts", "dd-MMM-yyyy hh:mm a")) \
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")) \
        .when(kind == "error", F.date_format("ts", "yyyy/MM/dd HH:mm")).otherwise(F.date_format("ts", STAMP))
    return t.events.select("event_id", stamp(parse_timestamp(raw)).alias("parsed"))


@query("epoch_millis_guarded", """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS added
    FROM events
""")
def epoch_millis_guarded(t):
    kind = F.col("event_type")
    raw = F.when(kind.isin("click", "view"), F.date_format("ts", "dd-MMM-yyyy HH:mm:ss")) \
        .when(kind == "error", F.lit("soon")).otherwise(F.unix_millis(F.col("ts").cast("timestamp")).cast("string"))
    return t.events.select("event_id", stamp(epoch_or_text(raw)).alias("added"))


@query("hhmm_to_minutes", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(hour(ts) * 60 + minute(ts) AS INTEGER) END AS minutes
    FROM events
""")
def hhmm_to_minutes(t):
    raw = F.when(F.col("event_type") == "error", F.date_format("ts", "HH.mm")).otherwise(F.date_format("ts", "HH:mm"))
    return t.events.select("event_id", clock_to_minutes(raw).alias("minutes"))


@query("time_of_day", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE strftime(ts, '%H:%M:%S') END AS clock FROM events
""")
def time_of_day_query(t):
    kind = F.col("event_type")
    raw = F.when(kind == "click", F.date_format("ts", "HH:mm:ss")).when(kind == "view", F.date_format("ts", "dd-MMM-yyyy HH:mm:ss")) \
        .when(kind == "error", F.lit("noon")).otherwise(F.date_format("ts", STAMP))
    return t.events.select("event_id", time_of_day(raw).alias("clock"))


@query("safe_casts", """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE CAST(p_partkey AS BIGINT) END AS as_long,
           CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_size END AS as_int,
           CASE WHEN p_type = 'LARGE' THEN NULL ELSE CAST(p_size AS TINYINT) END AS as_tiny,
           CAST(p_size / 10.0 AS DOUBLE) AS as_decimal,
           CAST(CASE p_type WHEN 'PROMO' THEN 1 WHEN 'SMALL' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 0 END AS TINYINT) AS as_flag
    FROM part
""")
def safe_casts(t):
    kind = F.col("p_type")
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    raw = t.part.select(
        "p_partkey", F.when(kind == "PROMO", F.concat(F.lit("P-"), key)).otherwise(key).alias("a"),
        F.when(kind == "SMALL", F.concat(size, F.lit(".5"))).otherwise(size).alias("b"),
        F.when(kind == "LARGE", F.lit("4000")).otherwise(size).alias("c"),
        (F.col("p_size") / 10).cast("string").alias("d"),
        F.when(kind == "PROMO", "true").when(kind == "SMALL", "false").when(kind == "LARGE", "1").when(kind == "MEDIUM", "0")
        .otherwise("maybe").alias("e"))
    return raw.select("p_partkey", to_long(F.col("a")).alias("as_long"), to_int(F.col("b")).alias("as_int"),
                      to_tiny(F.col("c")).alias("as_tiny"), to_decimal(F.col("d"), 4, 1).cast("double").alias("as_decimal"),
                      to_flag(F.col("e")).alias("as_flag"))


@query("previous_day_filter", """
    SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'
""")
def previous_day_filter(t):
    day = F.lit("1998-10-04").cast("date")
    return t.orders.filter(previous_day(F.col("o_orderdate"), day)).select("o_orderkey", "o_custkey")


@query("batch_dates_semi", """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS d FROM orders)
    SELECT o_orderkey, strftime(d, '%Y-%m-%d') AS day FROM o WHERE d IS NULL OR d IN (SELECT l_shipdate FROM lineitem)
""")
def batch_dates_semi(t):
    orders = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("d"))
    kept = in_batch_dates(orders, t.lineitem, "d", "l_shipdate")
    return kept.select("o_orderkey", F.date_format("d", "yyyy-MM-dd").alias("day"))


@query("hours_and_overtime", """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_size END AS hours_worked,
           CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_size > 8 END AS is_overtime
    FROM part
""")
def hours_and_overtime_query(t):
    raw = t.part.select("p_partkey", F.when(F.col("p_type") == "PROMO", "n/a").otherwise(F.col("p_size").cast("string")).alias("hours"))
    return hours_and_overtime(raw, "hours").drop("hours")


@query("file_safe_names", """
    SELECT page_id, regexp_replace(url, '[^0-9A-Za-z_.\\-\\p{L}]', '_', 'g') AS file_name FROM pages
""")
def file_safe_names(t):
    return t.pages.select("page_id", file_safe(F.col("url")).alias("file_name"))


@query("report_dates", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS report_date FROM orders
""")
def report_dates(t):
    mark = F.when(F.col("o_orderstatus") == "F", "Attendance Date : ").when(F.col("o_orderstatus") == "O", "Attendance Date- ").otherwise("Date: ")
    header = F.concat(F.lit("Daily report\n"), mark, F.date_format("o_orderdate", "dd-MMM-yyyy"), F.lit("\nend"))
    return t.orders.select("o_orderkey", parse_date(report_date_text(header)).cast("string").alias("report_date"))


@query("run_durations", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value * 1000) AS BIGINT) END AS duration_ms FROM events
""")
def run_durations(t):
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    end = F.when(F.col("event_type") != "error", start + F.floor(F.col("value") * 1000))
    return t.events.select("event_id", duration_millis(start, end).alias("duration_ms"))


@query("latest_per_key", """
    SELECT event_id, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
""")
def latest_per_key(t):
    return keep_latest(t.events, ["user_id", "event_type"], ["ts", "event_id"], tie_break=False) \
        .select("event_id", "user_id", "event_type", "value")


@query("row_index", """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_index FROM orders
""")
def row_index_query(t):
    return row_index(t.orders.select("o_orderkey"), ["o_orderkey"], integer_block(F.col("o_orderkey"), 1 << 12))


@query("record_hash", """
    SELECT c_custkey, concat_ws(' ', c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END) AS full_name,
           sha256(concat_ws('||', c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END, CAST(c_nationkey AS VARCHAR))) AS record_hash
    FROM customer
""")
def record_hash_query(t):
    rows = t.customer.withColumn("segment", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")))
    return rows.select("c_custkey", full_name(F.col("c_name"), F.col("segment")).alias("full_name"),
                       record_hash(["c_name", "segment", "c_nationkey"], parity=True).alias("record_hash"))


@query("union_missing_columns", """
    SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def union_missing_columns(t):
    return union_all([
        t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
        t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))])
