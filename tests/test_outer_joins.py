"""Outer joins whose null-filled side has a key with a third of all rows."""

import pytest
from pyspark.sql import functions as F

from tillwork.operators.joins import outer_join

ROWS, HOT = 30_000, 10_000


def people(spark):
    """Keys 0 to 99 and two rows without key; 7 twice. A third of the rows have key 500."""
    few = spark.range(100).select(F.col("id").alias("person"), F.col("id").alias("name"))
    more = spark.createDataFrame([(7, 7_000), (None, 8_000), (None, 8_001)], "person long, name long")
    many = spark.range(HOT).select(F.lit(500).cast("long").alias("person"), (F.col("id") + 10_000).alias("name"))
    return few.unionByName(more), few.unionByName(more).unionByName(many)


def sales(spark):
    """A third of the rows for key 7, some for keys that nobody has, some without key."""
    n = F.col("id")
    buyer = F.when(n < HOT, 7).when(n % 50 == 0, None).otherwise(n % 140)
    return spark.range(0, ROWS, 1, 8).select(buyer.cast("long").alias("buyer"), n.alias("sale"))


def same(one, other):
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


@pytest.fixture()
def shuffled(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
             "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.skewJoin.enabled"]
    before = {n: spark.conf.get(n, None) for n in names}
    for n, value in zip(names, ["-1", "-1", "false", "false"]):
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_hot_keys_give_the_rows_of_the_plain_join(how, spark, shuffled):
    for left in people(spark):
        right = sales(spark)
        plain = left.join(right, F.col("person") == F.col("buyer"), how)
        found = outer_join(left, right, "person", "buyer", how, hot_rows=500)
        assert found.columns == plain.columns
        assert same(found, plain)


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_no_task_holds_a_hot_key(how, spark, shuffled):
    left, right = people(spark)[0], sales(spark)
    if how == "right":  # the filled side is the left one
        one = outer_join(right, left, "buyer", "person", how, hot_rows=500)
    else:
        one = outer_join(left, right, "person", "buyer", how, hot_rows=500)
    most = one.filter("buyer = 7").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < HOT  # of 2 * HOT rows; a plain join has them all in one task
    plain = left.join(right, F.col("person") == F.col("buyer"), "left")
    tasks = plain.filter("buyer = 7").groupBy(F.spark_partition_id()).count().count()
    assert tasks == 1


def test_without_hot_keys_it_is_the_plain_join(spark):
    left, right = people(spark)[0], sales(spark)
    found = outer_join(left, right, "person", "buyer", "left")
    assert "_hot" not in found._jdf.queryExecution().optimizedPlan().toString()
    for one, other in [(left.limit(0), right), (left, right.limit(0))]:
        plain = one.join(other, F.col("person") == F.col("buyer"), "full")
        assert same(outer_join(one, other, "person", "buyer", "full", hot_rows=500), plain)
