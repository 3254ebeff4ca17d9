"""Blocked operators against plain windows, on groups of very uneven size."""

import random

from pyspark.sql import Window, functions as F

from strataflow.operators.blocks import carry_forward, integer_block, row_index, running_index


def frame(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = [("hot" if rnd.random() < 0.4 else f"k{rnd.randrange(20)}" if rnd.random() < 0.97 else None, i,
             f"v{i}" if rnd.random() < 0.05 else None) for i in range(n)]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "k string, ord bigint, v string")


def test_running_index_equals_row_number(spark):
    df = frame(spark)
    got = running_index(df, ["k"], ["ord"], integer_block(F.col("ord"), 100), "i")
    want = df.withColumn("i", F.row_number().over(Window.partitionBy("k").orderBy("ord")).cast("bigint"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_row_index_is_global_and_zero_based(spark):
    got = row_index(frame(spark), ["ord"], integer_block(F.col("ord"), 256)).collect()
    assert all(r.ord == r.row_index for r in got)


def test_carry_forward_equals_window(spark):
    df = frame(spark)
    got = carry_forward(df, ["k"], "ord", integer_block(F.col("ord"), 64), {"last_v": F.col("v")}, {"first_v": F.col("v")})
    up_to = Window.partitionBy("k").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("k").orderBy("ord").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    want = df.withColumn("last_v", F.last("v", True).over(up_to)).withColumn("first_v", F.first("v", True).over(whole))
    columns = ["k", "ord", "v", "last_v", "first_v"]
    assert sorted(map(repr, got.select(columns).collect())) == sorted(map(repr, want.select(columns).collect()))
