"""Plan properties that matter on large or skewed tables."""

import pytest
from pyspark.sql import functions as F

from strataflow.operators import dims, latest, upsert
from strataflow.operators.checks import corruption_checks, find_issues, pii_checks
from strataflow.operators.rules import RuleSet, analyze, repair, repair_log
from strataflow.workloads.repair import CONFIG


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = physical(latest.keep_latest(df, ["k"], ["id"]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_checks_and_repairs_do_not_shuffle(spark):
    df = spark.createDataFrame([(1, "a", "b")], "id int, name string, phone string")
    rules = RuleSet(CONFIG)
    for plan in (find_issues(df, corruption_checks(df) + pii_checks(df), "id"), analyze(df, rules, "id"), repair(df, rules),
                 repair_log(df, rules, "id")):
        assert "Exchange" not in physical(plan) and "Python" not in physical(plan)


@pytest.mark.parametrize("how", ["enrich", "absent"])
def test_hot_key_is_split_when_the_other_side_is_too_big_to_broadcast(spark, how):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 60000, 1, 8).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("employee_id"),
                                                  F.col("id").alias("payload"))
        dim = spark.range(0, 60000, 1, 8).select(F.col("id").alias("dim_employee_key"), F.col("id").cast("string").alias("employee_id"),
                                                 F.lit("x").alias("email_id"), F.lit(1).alias("is_current"))
        if how == "enrich":
            joined = dims.enrich(fact, dim, dim, date_col=None)
        else:
            joined = upsert.absent(fact, dim.select("employee_id"), "employee_id")
        rows = joined.collect()
        assert len(rows) == (60000 if how == "enrich" else 0)
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_salting_keeps_every_row(spark):
    fact = spark.range(1000).select(F.lit("7").alias("employee_id"), "id")
    dim = spark.createDataFrame([(70, "7", "m", 1), (80, "8", "m", 1)], "dim_employee_key int, employee_id string, email_id string, is_current int")
    got = dims.enrich(fact, dim, dim, date_col=None, salts=8)
    assert got.count() == 1000 and got.filter("dim_employee_key = 70").count() == 1000


def test_previous_day_prunes_partitions(spark, lake):
    from strataflow.functions.temporal import previous_day
    df = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "d string, v int").withColumn("d", F.to_date("d"))
    lake.replace_partitions(df, "c.gold.t", "d")
    hit = lake.read("c.gold.t", df.schema).filter(previous_day(F.col("d"), F.lit("2026-01-02").cast("date")))
    assert [r.v for r in hit.collect()] == [1]
    assert "PartitionFilters: [isnotnull(d" in physical(hit)


def test_blocked_operators_shuffle_rows_once(spark):
    from strataflow.operators.blocks import carry_forward, integer_block, running_index
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id", F.col("id").cast("string").alias("wide"))
        block = integer_block(F.col("id"), 100)
        for out in (running_index(df, ["k"], ["id"], block, "i"), carry_forward(df, ["k"], "id", block, {"v": F.col("k")})):
            # Shuffled: the rows, the block counts, the counts by group, the offsets.
            assert physical(out).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partitioned_writes_make_few_files(spark, lake, tmp_path):
    df = spark.range(0, 4000, 1, 16).select("id", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("d"))
    lake.replace_partitions(df, "c.gold.t", "d")
    lake.overwrite(df, "c.gold.u", ["d"])
    for table in ("t", "u"):
        assert len(list((tmp_path / "lake" / "gold" / table).rglob("*.parquet"))) == 5
    assert lake.read("c.gold.t").count() == 4000
