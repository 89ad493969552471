"""Joins of bucketed tables: no rows move, and a hot key is the work of many tasks."""

import pytest
from pyspark.sql import functions as F

from fareflow.operators import clustered
from fareflow.session import new_table
from tests.conftest import plan, rows, setting

BUCKETS = 4


def make(spark, hot_left=True, hot_right=True):
    """Two tables with null keys, keys of one side only, and a key that holds a third of a side's rows."""
    key = F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 40)
    left = spark.range(900).select(key.alias("key"), F.col("id").alias("x"))
    right = spark.range(300).select((F.col("id") % 60 + 5).alias("key"), F.col("id").alias("y"))
    if hot_left:
        left = left.withColumn("key", F.when(F.col("x") % 3 == 0, F.lit(7)).otherwise(F.col("key")))
    if hot_right:
        right = right.withColumn("key", F.when(F.col("y") % 3 == 0, F.lit(9)).when(F.col("y") % 3 == 1, F.lit(7)).otherwise(F.col("key")))
    return left, right


def tables(spark, left, right):
    return [clustered.create_clustered(df, new_table(label), "key", BUCKETS) for df, label in ((left, "l"), (right, "r"))]


@pytest.mark.parametrize("few", [100_000, 0], ids=["broadcast", "salt"])
@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("hot", [(False, False), (True, False), (False, True), (True, True)])
def test_rows_are_those_of_a_plain_join(spark, monkeypatch, few, how, hot):
    monkeypatch.setattr(clustered, "FEW_ROWS", few)
    left, right = make(spark, *hot)
    a, b = tables(spark, left, right)
    assert (7 in a.hot_keys, 9 in b.hot_keys) == hot
    found = clustered.join_clustered(spark, a, b, how)
    assert rows(found.select("key", "x", "y")) == rows(left.join(right, "key", how).select("key", "x", "y"))
    assert a.rows(spark).count() == 900


def test_buckets_are_joined_in_place(spark):
    a, b = tables(spark, *make(spark, False, False))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        joined = clustered.join_clustered(spark, a, b)
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        a, b = tables(spark, *make(spark))
        text = plan(clustered.join_clustered(spark, a, b))
        # The parts of the hot keys send the other side's few rows, and nothing is shuffled.
        assert "Exchange hashpartitioning" not in text and text.count("SortMergeJoin") == 1


def test_a_hot_key_is_spread_over_tasks(spark, monkeypatch):
    """Two thirds of 60,000 rows have one key; the other side is joined by salt."""
    monkeypatch.setattr(clustered, "FEW_ROWS", 0)
    left = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, F.lit(5)).otherwise(F.col("id") % 1000).alias("key"), F.col("id").alias("x"))
    right = spark.range(1000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("y"))
    a, b = tables(spark, left, right)
    assert a.hot_keys == (5,) and spark.table(a.name).filter("key = 5").isEmpty()
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), setting(spark, "spark.sql.adaptive.enabled", "false"):
        joined = clustered.join_clustered(spark, a, b).withColumn("task", F.spark_partition_id())
        hot = [r["count"] for r in joined.filter("key = 5").groupBy("task").count().collect()]
    assert sum(hot) == 40_020 and len(hot) >= 3 and max(hot) < 30_000


def test_open_and_refuse(spark):
    a, b = tables(spark, *make(spark))
    assert clustered.open_clustered(spark, a.name, "key", BUCKETS) == a
    with pytest.raises(ValueError, match="how"):
        clustered.join_clustered(spark, a, b, "full")
    other = clustered.create_clustered(make(spark)[0], new_table("o"), "key", 8)
    with pytest.raises(ValueError, match="buckets"):
        clustered.join_clustered(spark, a, other)


def test_empty_tables(spark):
    left, right = make(spark)
    a, b = tables(spark, left.limit(0), right)
    assert a.hot_keys == () and clustered.join_clustered(spark, a, b).isEmpty()
    a, b = tables(spark, left, right.limit(0))
    assert clustered.join_clustered(spark, a, b, "left").count() == 900
