from datetime import date

import pytest
from pyspark.sql import functions as F

from tillwork.operators import scd2
from tillwork.operators.joins import as_of

OPENED, CHANGED = date(2024, 1, 1), date(2024, 6, 1)


@pytest.fixture()
def products(spark):
    return scd2.init(
        spark.createDataFrame([(1, "pen", 1.0), (2, "cup", 2.0), (3, "mat", 3.0)], "id long, name string, price double"),
        OPENED,
    )


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "id long, price double")


def apply(spark, table, at, *rows):
    return scd2.apply_changes(table, changes(spark, *rows), "id", at, ["price"])


def check_invariants(table):
    current = table.filter("is_current").groupBy("id").count()
    assert current.filter("count <> 1").isEmpty()
    other = table.select(F.col("id").alias("i"), F.col("effective_date").alias("e"), F.col("end_date").alias("x"))
    overlap = table.join(
        other,
        (F.col("id") == F.col("i")) & (F.col("effective_date") < F.col("e"))
        & (F.coalesce("end_date", F.lit(date(9999, 1, 1))) > F.col("e")),
    )
    assert overlap.isEmpty()
    assert table.filter("end_date <= effective_date").isEmpty()


def test_change_closes_and_opens(spark, products):
    table = apply(spark, products, CHANGED, (1, 1.5), (9, 4.0))
    assert table.count() == 4
    check_invariants(table)
    old, new = scd2.history(table, "id", 1).collect()
    assert (old["price"], old["end_date"], old["is_current"]) == (1.0, CHANGED, False)
    assert (new["price"], new["effective_date"], new["end_date"]) == (1.5, CHANGED, None)


def test_running_a_batch_again_changes_nothing(spark, products):
    once = apply(spark, products, CHANGED, (1, 1.5), (2, 2.0))
    again = apply(spark, once, CHANGED, (1, 1.5), (2, 2.0))
    assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty()
    later = apply(spark, once, date(2024, 9, 1), (1, 1.5))
    assert later.exceptAll(once).isEmpty()


def test_second_change_on_the_same_day_replaces_the_first(spark, products):
    table = apply(spark, apply(spark, products, CHANGED, (1, 1.5)), CHANGED, (1, 1.7))
    check_invariants(table)
    assert [r["price"] for r in scd2.history(table, "id", 1).collect()] == [1.0, 1.7]


def test_history_is_not_closed_again(spark, products):
    table = apply(spark, products, CHANGED, (1, 1.5))
    table = apply(spark, table, date(2024, 9, 1), (1, 1.9))
    check_invariants(table)
    ends = [r["end_date"] for r in scd2.history(table, "id", 1).collect()]
    assert ends == [CHANGED, date(2024, 9, 1), None]


def test_change_in_the_past_and_double_change_fail(spark, products):
    with pytest.raises(Exception, match="precedes the first version"):
        apply(spark, products, date(2023, 1, 1), (1, 1.5)).collect()
    with pytest.raises(Exception, match="several changes"):
        apply(spark, products, CHANGED, (1, 1.5), (1, 1.6)).collect()


def test_a_late_change_splits_the_version_in_force(spark, products):
    table = apply(spark, apply(spark, products, CHANGED, (1, 1.5)), date(2024, 9, 1), (1, 1.9), (2, 2.5))
    late = apply(spark, table, date(2024, 7, 1), (1, 1.7), (2, 2.2), (9, 1.0))
    check_invariants(late)
    versions = [(r["price"], r["effective_date"], r["end_date"]) for r in scd2.history(late, "id", 1).collect()]
    assert versions == [
        (1.0, OPENED, CHANGED), (1.5, CHANGED, date(2024, 7, 1)),
        (1.7, date(2024, 7, 1), date(2024, 9, 1)), (1.9, date(2024, 9, 1), None),
    ]
    assert [r["price"] for r in scd2.history(late, "id", 2).collect()] == [2.0, 2.2, 2.5]
    assert late.count() == table.count() + 2
    # Again, on the first day of a version, and with the value that was in force: no new rows.
    again = apply(spark, late, date(2024, 7, 1), (1, 1.7), (2, 2.2))
    assert again.exceptAll(late).isEmpty() and late.exceptAll(again).isEmpty()
    replaced = apply(spark, late, date(2024, 7, 1), (1, 1.8))
    assert replaced.count() == late.count()
    assert [r["price"] for r in scd2.history(replaced, "id", 1).collect()] == [1.0, 1.5, 1.8, 1.9]
    assert apply(spark, late, date(2024, 8, 1), (1, 1.7)).exceptAll(late).isEmpty()


def test_as_of(spark, products):
    table = apply(spark, products, CHANGED, (1, 1.5))
    assert scd2.as_of(table, date(2024, 5, 31)).filter("id = 1").first()["price"] == 1.0
    assert scd2.as_of(table, CHANGED).filter("id = 1").first()["price"] == 1.5
    assert scd2.current(table).count() == 3
    sales = spark.createDataFrame(
        [(1, date(2024, 5, 31)), (1, CHANGED), (1, date(2023, 1, 1)), (2, date(2030, 1, 1))], "sold long, d date"
    )
    prices = as_of(sales, table, "sold", "id", "d").select("d", "price").collect()
    assert sorted(r["price"] for r in prices) == [1.0, 1.5, 2.0]


def test_row_maintenance(spark):
    stock = spark.createDataFrame([(1, 10), (2, 5)], "item long, level long")
    demand = spark.createDataFrame([(1, 3), (1, 4)], "item long, q long")
    left = scd2.take_stock(stock, demand, "item", "level", "q").collect()
    assert {r["item"]: r["level"] for r in left} == {1: 3, 2: 5}
    assert scd2.delete_rows(stock, F.col("level") < 6).count() == 1
    updates = spark.createDataFrame([(2, 50)], "item long, level long")
    merged = scd2.merge_update(stock, updates, "item", ["level"]).collect()
    assert {r["item"]: r["level"] for r in merged} == {1: 10, 2: 50}
    orders = spark.createDataFrame(
        [(100, 1, 6), (101, 1, 6), (101, 2, 1), (102, 1, 1), (103, 7, 1)], "ord long, item long, q long"
    )
    served = {r["ord"]: r["accepted"] for r in scd2.guard_stock(orders, stock, "ord", "item", "q", "level").collect()}
    # 101 is refused and takes nothing, so 102 is served; 103 wants an unknown item.
    assert served == {100: True, 101: False, 102: True, 103: False}


def test_stock_is_guarded_as_one_order_after_the_other(spark):
    import random

    rng = random.Random(3)
    stock = {k: rng.randint(0, 40) for k in range(8)}
    orders = {o: {rng.randrange(9): rng.randint(1, 9) for _ in range(rng.randint(1, 3))} for o in range(120)}
    left, expected = dict(stock), {}
    for o, items in orders.items():
        expected[o] = all(left.get(i, -1) >= q for i, q in items.items())
        if expected[o]:
            for i, q in items.items():
                left[i] -= q
    demand = spark.createDataFrame([(o, i, q) for o, x in orders.items() for i, q in x.items()], "ord long, item long, q long")
    levels = spark.createDataFrame(list(stock.items()), "item long, level long")
    for few in (0, scd2.FEW):
        found = scd2.guard_stock(demand, levels, "ord", "item", "q", "level", few).collect()
        assert {r["ord"]: r["accepted"] for r in found} == expected


def test_a_long_chain_of_dependent_orders_takes_one_task(spark, monkeypatch):
    # Order k wants items k and k + 1, of which there is one each: a round would decide one order.
    pins, pin = [], scd2.pin
    monkeypatch.setattr(scd2, "pin", lambda df, label="x": pins.append(label) or pin(df, label))
    demand = spark.range(5_000).select(
        F.col("id").alias("ord"), F.explode(F.array("id", F.col("id") + 1)).alias("item"), F.lit(1).cast("long").alias("q")
    )
    demand = demand.unionByName(spark.createDataFrame([(-5, 3, None)], "ord long, item long, q long"))
    stock = spark.range(5_001).select(F.col("id").alias("item"), F.lit(1).cast("long").alias("level"))
    found = scd2.guard_stock(demand, stock, "ord", "item", "q", "level")
    wrong = found.filter(F.col("accepted") != ((F.col("ord") % 2 == 0) | (F.col("ord") < 0)))
    assert found.count() == 5_001 and wrong.isEmpty()
    assert len(pins) <= 3


def test_a_chain_of_dependent_orders_and_a_hot_item(spark):
    # Order k wants items k and k + 1, of which there is one each: every other order is served.
    demand = [(k, i, 1) for k in range(8) for i in (k, k + 1)]
    # A third item is in every order, beyond what is left of it for the last ones.
    demand += [(k, 1000, 2) for k in range(100, 300)] + [(None, 1000, 1), (301, None, 1)]
    stock = spark.createDataFrame([(k, 1) for k in range(9)] + [(1000, 201)], "item long, level long")
    orders = spark.createDataFrame(demand, "ord long, item long, q long").repartition(5)
    found = {r["ord"]: r for r in scd2.guard_stock(orders, stock, "ord", "item", "q", "level").collect()}
    assert all(found[k]["accepted"] == (k % 2 == 0) for k in range(8))
    assert all(found[k]["accepted"] == (k < 200) for k in range(100, 300))
    assert found[None]["accepted"] and not found[301]["accepted"]
    assert found[1]["items"] == 2 and found[1]["items_in_stock"] == 1 and found[299]["items_in_stock"] == 0


def test_rounds_hand_on_only_what_is_undecided(spark, monkeypatch):
    sizes, pin = [], scd2.pin

    def counted(df, label="x"):
        kept = pin(df, label)
        sizes.append(kept.filter("_state is null or _state = 1").count())
        return kept

    monkeypatch.setattr(scd2, "pin", counted)
    demand = [(k, 0, 1) for k in range(500)] + [(1000 + k, i, 1) for k in range(6) for i in (k + 1, k + 2)]
    stock = spark.createDataFrame([(0, 500)] + [(k, 1) for k in range(1, 8)], "item long, level long")
    orders = spark.createDataFrame(demand, "ord long, item long, q long")
    scd2.guard_stock(orders, stock, "ord", "item", "q", "level", few=0).collect()
    assert sizes[0] == 512 and max(sizes[2:]) <= 12 and sizes[-1] <= 4


def test_a_round_moves_its_rows_once(spark):
    from tillwork.operators.ordered import SLICE

    row = "ord long, item long, _asked long, _level long, _before long, _state int"
    rows = spark.createDataFrame([(k, k % 3, 1, 9, 0, None) for k in range(50)], row)
    rows = scd2.pin(rows.withColumn(SLICE, (F.col("ord") / 10).cast("int")))
    text = scd2._guard_step(rows, "ord", "item", 4)._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moves) == 4  # the rows by range; sums by item and range, by item, by range
    assert not any("hashpartitioning(ord" in line for line in moves)


def test_as_of_a_product_with_very_many_versions(spark):
    first = date(1900, 1, 1)
    many = spark.range(100_000).select(
        (F.col("id") / 40_000).cast("long").alias("id"), F.col("id").alias("price"),
        F.date_add(F.lit(first), (F.col("id") % 40_000).cast("int")).alias("effective_date"),
    )
    # The last version of each product is closed the day after it began.
    versions = many.withColumn("end_date", F.date_add("effective_date", 1)).withColumn("is_current", F.lit(False))
    sales = spark.range(50_000).select(
        F.col("id").alias("sale"), F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 4).alias("sold"),
        F.date_add(F.lit(first), (F.col("id") % 41_000 - 500).cast("int")).alias("d"),
    )
    found = as_of(sales, versions, "sold", "id", "d")
    sold, day = F.col("sold"), F.col("sale") % 41_000 - 500
    size = F.when(sold == 2, 20_000).when(sold < 2, 40_000).otherwise(0)
    expected = sales.filter((day >= 0) & (day < size)).select("sale", (sold * 40_000 + day).alias("price"))
    got = found.select("sale", "price")
    assert got.count() == expected.count() > 25_000
    assert got.exceptAll(expected).isEmpty()
    assert found.columns == [*sales.columns, *versions.columns]
    assert as_of(sales.limit(0), versions, "sold", "id", "d").isEmpty()
    assert as_of(sales, versions.limit(0), "sold", "id", "d").isEmpty()
