"""Physical plans: what reaches the scan, and what must never appear."""

import re

import pytest

import __spark_entry__ as entry
from tests.conftest import DATA
from tillwork.plans import load

# The text queries have tests of their own.
QUERIES = {name: run for name, run in entry.queries().items() if name in load().QUERIES}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scans(text, column):
    return [line for line in text.splitlines() if "FileScan" in line and column in line]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_and_no_python(name, spark):
    text = plan(QUERIES[name](spark, DATA))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonMap"):
        assert bad not in text


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["filter_date_range"](spark, DATA))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in text
    text = plan(QUERIES["select_filter_chain"](spark, DATA))
    assert "EqualTo(l_returnflag,R)" in text and "l_tax" not in text
    text = plan(QUERIES["lookup_by_key"](spark, DATA))
    assert "PushedFilters: [In(c_custkey, [" in text
    text = plan(QUERIES["period_top_products"](spark, DATA))
    assert "GreaterThanOrEqual(o_orderdate" in text
    text = plan(QUERIES["orders_last_12_months"](spark, DATA))
    assert "GreaterThanOrEqual(o_orderdate" in text


def test_only_needed_columns_are_read(spark):
    text = plan(QUERIES["revenue_by_category"](spark, DATA))
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_discount:double>" in text


def test_facts_are_summed_before_they_are_joined(spark):
    text = plan(QUERIES["customer_360"](spark, DATA))
    lines = [line.strip(" :+-*()0123456789") for line in text.splitlines()]
    aggregate = next(i for i, line in enumerate(lines) if line.startswith("HashAggregate(keys=[o_custkey"))
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert join < aggregate  # the join sits above the aggregate


def test_orders_are_told_apart_for_the_top_parts_only(spark):
    lines = plan(QUERIES["top_products_qty"](spark, DATA)).splitlines()
    by_order = [k for k, line in enumerate(lines) if re.search(r"Aggregate\(keys=\[[^]]*l_orderkey", line)]
    semi = [k for k, line in enumerate(lines) if "LeftSemi" in line]
    assert by_order and any(k > max(by_order) for k in semi)  # the join lies below the aggregates


def test_top_k_and_first_rows_are_cut_before_the_shuffle(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top10_products"](spark, DATA))
    for name in ("dedup_keep_first", "top3_per_category"):
        text = plan(QUERIES[name](spark, DATA))
        assert len(re.findall("WindowGroupLimit", text)) >= 2
        assert "Partial" in text


@pytest.fixture()
def settings(spark):
    before = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_spark_decides_what_to_broadcast(spark, settings):
    assert "BroadcastHashJoin" in plan(QUERIES["join_broadcast"](spark, DATA))
    settings(autoBroadcastJoinThreshold="-1")
    assert "SortMergeJoin" in plan(QUERIES["join_broadcast"](spark, DATA))


@pytest.mark.parametrize("name", ["join_left", "join_right", "join_full"])
def test_outer_joins_scan_each_input_once(name, spark):
    assert plan(QUERIES[name](spark, DATA)).count("FileScan") == 2


def test_a_hot_key_is_split_when_it_is_joined(spark, settings):
    from pyspark.sql import functions as F

    from tillwork.operators.joins import as_of

    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="10k",
        adaptive__coalescePartitions__enabled="false",
    )
    day = F.lit("2024-01-01").cast("date")
    facts = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") < 40_000, 7).otherwise(F.col("id")).alias("sold"), F.col("id").alias("n"), day.alias("d")
    )
    versions = spark.range(60_000).select(
        F.col("id").alias("item"), day.alias("effective_date"), F.lit(None).cast("date").alias("end_date")
    )
    joined = as_of(facts, versions, "sold", "item", "d")
    joined.collect()
    assert "skew=true" in plan(joined)
