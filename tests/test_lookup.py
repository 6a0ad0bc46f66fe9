"""Lookup joins: the same rows whether the table is broadcast or shuffled, for every key type."""

import pytest
from pyspark.sql import functions as F

from changeflow.operators.lookup import lookup


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_forms_agree(spark, how, null_safe):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50)
    df = spark.range(3000).select("id", key.cast("int").alias("k"))
    table = spark.range(0, 50, 2).select(F.col("id").alias("r"), (F.col("id") * 10).alias("v")).union(spark.sql("select 7L, 70L"))
    table = table.union(spark.sql("select cast(null as bigint), -1L")).union(spark.sql("select 1L << 40, 0L"))
    join = lambda: sorted(map(str, lookup(df, table, ["k"], ["r"], how, null_safe).collect()))
    broadcast = join()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert join() == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_text_and_number_keys_meet(spark):
    df = spark.range(1000).select("id", F.lit("007").alias("k"))
    table = spark.sql("select 7 as r, 'seven' as v")
    assert lookup(df, table, ["k"], ["r"]).filter("v = 'seven'").count() == 1000


def test_no_side_is_forced_to_every_executor(spark):
    plan = lookup(spark.range(10), spark.range(10).select(F.col("id").alias("r")), ["id"], ["r"])
    assert "hint" not in plan._jdf.queryExecution().logical().toString().lower()
