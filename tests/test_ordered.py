"""The sliced windows against plain windows, with a group of a third of all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwork.operators.ordered import SLICE, over_ordered, slice_count, slices


@pytest.fixture(scope="module")
def rows(spark):
    group = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 97 != 0, F.col("id") % 40)
    value = F.when(F.rand(1) < 0.4, 7).otherwise((F.rand(2) * 50).cast("int"))
    return spark.range(6000).select("id", group.cast("int").alias("g"), value.alias("v")).persist()


def plain(rows, group, descending):
    by = F.desc("v") if descending else F.asc("v")
    full = Window.partitionBy(*group).orderBy(by, "id")
    tied = Window.partitionBy(*group).orderBy(by)
    return rows.select(
        "*",
        F.row_number().over(full).cast("long").alias("rn"),
        F.rank().over(tied).cast("long").alias("rk"),
        F.dense_rank().over(tied).cast("long").alias("dr"),
        F.ntile(4).over(full).cast("long").alias("nt"),
        F.sum("v").over(full.rowsBetween(Window.unboundedPreceding, 0)).alias("run"),
        F.sum("v").over(Window.partitionBy(*group)).alias("tot"),
        F.lag("id").over(full).alias("prev"),
    )


@pytest.mark.parametrize("group", [[], ["g"]])
@pytest.mark.parametrize("direction", ["asc", "desc"])
def test_same_as_plain_windows(rows, group, direction):
    found = over_ordered(
        rows, [("v", direction), ("id", "asc")], group=group, ties=1,
        row_number="rn", rank="rk", dense_rank="dr", ntile=("nt", 4),
        running={"run": "v"}, totals={"tot": "v"}, lag={"prev": "id"},
    )
    expected = plain(rows, group, direction == "desc")
    assert found.count() == rows.count()
    assert found.exceptAll(expected).isEmpty()
    assert expected.exceptAll(found).isEmpty()


@pytest.mark.parametrize("group", [[], ["g"]])
def test_sums_alone_need_no_ordered_summary(rows, group):
    found = over_ordered(rows, [("v", "asc"), ("id", "asc")], group=group,
                         row_number="rn", running={"run": "v"}, totals={"tot": "v"})
    expected = plain(rows, group, False).select(*found.columns)
    assert found.exceptAll(expected).isEmpty()


def test_ntile_with_more_buckets_than_rows(spark):
    few = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "id long, v int")
    found = over_ordered(few, [("v", "asc"), ("id", "asc")], ntile=("nt", 5))
    assert sorted(r["nt"] for r in found.collect()) == [1, 2, 3]


def test_a_hot_group_is_cut_into_even_slices(spark, rows):
    sliced = slices(rows, ["g"], [("v", "asc"), ("id", "asc")], slice_count(rows))
    sizes = [r["count"] for r in sliced.groupBy(SLICE).count().collect()]
    assert len(sizes) > 4
    assert max(sizes) < 2 * rows.count() / len(sizes)
    hot = sliced.filter("g = 0").select(SLICE).distinct().count()
    assert hot > 1


def test_empty_input(spark):
    none = spark.createDataFrame([], "id long, v int")
    assert over_ordered(none, [("v", "asc"), ("id", "asc")], row_number="rn").count() == 0


def test_slices_grow_with_the_input(spark):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert slice_count(spark.range(10)) == least
    assert slice_count(spark.range(10 * least + 1), per_slice=10) == least + 1
    assert slice_count(spark.range(1000 * least), per_slice=10) == 100 * least


def test_pairs_of_names_with_one_order_of_many_names(spark):
    from tillwork.plans.business import pairs_of

    rows = [(1, f"rare{k}", 1, 1) for k in range(300)]
    rows += [(o, n, 1, 1) for o in range(2, 60) for n in ("a", "b", "c")]
    named = spark.createDataFrame(rows, "l_orderkey long, p_name string, n long, same long")
    found = pairs_of(named, 3).orderBy("product_a", "product_b").collect()
    top = [(r[0], r[1], r[2]) for r in found if r[2] > 1]
    assert top == [("a", "b", 58), ("a", "c", 58), ("b", "c", 58)]
    assert len(found) == 3  # the rare names are gone before they are paired


def test_the_input_runs_once_and_is_shuffled_once(spark, rows):
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda v: seen.add(1) or v, "int")
    upstream = rows.select("id", "g", counted("v").alias("v"))
    found = over_ordered(
        upstream, [("v", "desc"), ("id", "asc")], group=["g"], ties=1, row_number="rn", rank="rk",
        dense_rank="dr", ntile=("nt", 4), running={"run": "v"}, totals={"tot": "v"}, lag={"prev": "id"},
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == rows.count() == seen.value
    # The one full shuffle is the layout. What is left gathers two rows a slice.
    moved = [line for line in plan.split("\n") if "Exchange" in line]
    whole = [line for line in plan[: plan.index("BroadcastExchange")].split("\n") if "Exchange " in line]
    assert not whole and "rangepartitioning" not in plan
    assert len([line for line in moved if "Broadcast" not in line]) <= 2, moved


def test_tables_go_with_the_release(spark):
    from tillwork.sources import shared

    few = spark.createDataFrame([(1, 10), (2, 20)], "id long, v int")
    before = {t.name for t in spark.catalog.listTables()}
    assert over_ordered(few, [("v", "asc")], row_number="rn").count() == 2
    made = {t.name for t in spark.catalog.listTables()} - before
    assert len(made) == 1 and made <= set(shared._TABLES[spark.sparkContext.applicationId])
