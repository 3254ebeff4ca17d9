"""Lookup, upsert and type-2 dimension queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import record_hash
from ..operators import dims, scd, upsert
from .cleaning import stamp
from .registry import query

FIRST_LOAD = "2024-01-01 00:00:00"
SECOND_LOAD = "2024-02-01 00:00:00"


def employees(t):
    """Customers as an employee dimension; those with a negative balance are no longer current."""
    return t.customer.select(
        F.col("c_custkey").alias("dim_employee_key"), F.col("c_custkey").cast("string").alias("employee_id"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@corp.example")).alias("email_id"),
        F.when(F.col("c_acctbal") >= 0, 1).otherwise(0).alias("is_current"))


def order_facts(t):
    return t.orders.select("o_orderkey", F.col("o_custkey").alias("employee_id"), F.col("o_orderdate").cast("date").alias("work_date"))


@query("dim_enrich", """
    SELECT o_orderkey, CASE WHEN c_acctbal >= 0 THEN c_custkey END AS dim_employee_key,
           CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS dim_date_key
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def dim_enrich(t):
    facts = order_facts(t)
    return dims.enrich(facts, employees(t), dims.date_dimension(facts, "work_date")) \
        .select("o_orderkey", "dim_employee_key", "dim_date_key")


@query("dim_enrich_salted", """
    SELECT o_orderkey, CASE WHEN c_acctbal >= 0 THEN c_custkey END AS dim_employee_key
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey
""")
def dim_enrich_salted(t):
    facts = order_facts(t)
    return dims.enrich(facts, employees(t), employees(t), date_col=None, salts=4).select("o_orderkey", "dim_employee_key")


@query("dim_enrich_email_fallback", """
    SELECT o_orderkey, c_custkey AS dim_employee_key FROM orders JOIN customer ON c_custkey = o_custkey AND c_acctbal >= 0
""")
def dim_enrich_email_fallback(t):
    mail = F.format_string("customer.%09d@corp.example", F.col("o_custkey"))
    facts = t.orders.select("o_orderkey", mail.alias("email"))
    found = dims.enrich(facts, employees(t), employees(t), employee_col=None, date_col=None)
    return dims.resolved(found).select("o_orderkey", "dim_employee_key")


@query("dim_rejects", """
    SELECT o_orderkey, o_custkey AS employee_id FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)
""")
def dim_rejects(t):
    return dims.rejects(order_facts(t), employees(t), "employee_id", "employee_id").select("o_orderkey", "employee_id")


@query("date_dimension", """
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS dim_date_key, strftime(d, '%Y-%m-%d') AS full_date
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d FROM orders)
""")
def date_dimension(t):
    calendar = dims.date_dimension(t.orders, "o_orderdate")
    return calendar.select("dim_date_key", F.col("full_date").cast("string").alias("full_date"))


@query("anti_join_new", """
    SELECT p_partkey, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_discount > 0.08)
""")
def anti_join_new(t):
    discounted = t.lineitem.filter(F.col("l_discount") > 0.08).select(F.col("l_partkey").alias("p_partkey"))
    return upsert.absent(t.part, discounted, "p_partkey", narrow_batch=True).select("p_partkey", "p_name")


def loaded_orders(t):
    """What an earlier load left: orders up to the end of 1998, with the old status text."""
    return t.orders.filter(F.col("o_orderdate") < "1999-01-01").withColumn("o_orderstatus", F.lit("loaded"))


@query("insert_if_absent", """
    SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'loaded' ELSE o_orderstatus END AS o_orderstatus FROM orders
""")
def insert_if_absent(t):
    return upsert.insert_if_absent(loaded_orders(t), t.orders, "o_orderkey").select("o_orderkey", "o_orderstatus")


@query("delete_insert_by_date", """
    WITH batch AS (SELECT o_orderkey, o_orderdate, 'new' AS state FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01')
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, 'loaded' AS state FROM orders
    WHERE o_orderdate < TIMESTAMP '1999-01-01' AND o_orderdate NOT IN (SELECT o_orderdate FROM batch)
    UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d'), state FROM batch
""")
def delete_insert_by_date(t):
    target = loaded_orders(t).select("o_orderkey", "o_orderdate", F.col("o_orderstatus").alias("state"))
    batch = t.orders.filter(F.col("o_orderdate") >= "1998-06-01").select("o_orderkey", "o_orderdate", F.lit("new").alias("state"))
    merged = upsert.delete_insert(target, batch, "o_orderdate")
    return merged.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "state")


@query("within_keys", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def within_keys(t):
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return upsert.within_keys(t.orders, returned, "o_orderkey").select("o_orderkey", "o_totalprice")


def first_snapshot(t):
    """Customers of the first load: everybody outside the FURNITURE segment."""
    rows = t.customer.filter(F.col("c_mktsegment") != "FURNITURE").select(
        F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return rows.withColumn("record_hash", record_hash(["name", "segment"]))


def second_snapshot(t):
    """Second load: indebted customers moved to a new segment; BUILDING customers are missing."""
    moved = F.when(F.col("c_acctbal") < 0, "ARREARS").otherwise(F.col("c_mktsegment"))
    rows = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("name"), moved.alias("segment"))
    return rows.withColumn("record_hash", record_hash(["name", "segment"]))


def first_version(t):
    snapshot = first_snapshot(t)
    return scd.apply_snapshot(scd.first_history(snapshot), snapshot, "employee_id", F.lit(FIRST_LOAD).cast("timestamp"))


def second_version(t, **options):
    return scd.apply_snapshot(first_version(t), second_snapshot(t), "employee_id", F.lit(SECOND_LOAD).cast("timestamp"), **options)


def version_columns(df):
    return df.select("employee_id", "name", "segment", stamp("valid_from").alias("valid_from"),
                     stamp("valid_to").alias("valid_to"), "is_current")


SCD_SQL = f"""
    WITH versions AS (
        SELECT c_custkey AS employee_id, c_name AS name, c_mktsegment AS segment, '{FIRST_LOAD}' AS valid_from,
               CASE WHEN c_acctbal < 0 AND c_mktsegment <> 'BUILDING' THEN '{SECOND_LOAD}' END AS valid_to
        FROM customer WHERE c_mktsegment <> 'FURNITURE'
        UNION ALL
        SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'ARREARS' ELSE c_mktsegment END, '{SECOND_LOAD}', NULL
        FROM customer WHERE c_mktsegment <> 'BUILDING' AND (c_mktsegment = 'FURNITURE' OR c_acctbal < 0))
    SELECT *, CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_current FROM versions
"""


@query("scd2_change_classes", """
    SELECT c_custkey AS employee_id, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'new' WHEN c_acctbal < 0 THEN 'changed'
        ELSE 'unchanged' END AS change_class
    FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def scd2_change_classes(t):
    return scd.change_classes(second_snapshot(t), first_version(t), "employee_id").select("employee_id", "change_class")


@query("scd2_history", SCD_SQL)
def scd2_history(t):
    return version_columns(second_version(t))


@query("scd2_current", f"SELECT employee_id, segment FROM ({SCD_SQL}) WHERE is_current = 1")
def scd2_current(t):
    return dims.current_rows(second_version(t)).select("employee_id", "segment")


@query("scd2_expire_missing", f"""
    SELECT employee_id, segment, valid_from, CASE WHEN segment = 'BUILDING' THEN '{SECOND_LOAD}' ELSE valid_to END AS valid_to,
           CASE WHEN segment = 'BUILDING' THEN 0 ELSE is_current END AS is_current
    FROM ({SCD_SQL})
""")
def scd2_expire_missing(t):
    return version_columns(second_version(t, expire_missing=True)).drop("name")


@query("scd2_reapplied", SCD_SQL)
def scd2_reapplied(t):
    again = scd.apply_snapshot(second_version(t), second_snapshot(t), "employee_id", F.lit("2024-03-01 00:00:00").cast("timestamp"))
    return version_columns(again)
