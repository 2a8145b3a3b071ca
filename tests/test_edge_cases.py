"""Bad records are found and reported, never dropped in silence."""

from datetime import datetime

from pyspark.sql import functions as F

from tillwork.operators import clean, flows, profile, validate
from tillwork.operators.joins import having_match


def test_item_without_order(spark):
    orders = spark.createDataFrame([(1,), (2,), (3,)], "order_id long")
    items = spark.createDataFrame([(1, 1), (2, 2), (3, 999), (4, None)], "item_id long, ref long")
    lost = validate.orphan_rows(items, orders, "ref", "order_id")
    assert sorted(r["item_id"] for r in lost.collect()) == [3, 4]
    assert having_match(items, orders, "ref", "order_id").count() == 2


def test_discount_out_of_range(spark):
    items = spark.createDataFrame([(50,), (150,), (-10,)], "d int")
    bad = profile.count_rules(items, {"bad": (F.col("d") < 0) | (F.col("d") > 100)})
    assert bad.first()["n"] == 2
    share = F.lit(1) - clean.clamp(F.col("d"), 0, 100) / 100
    assert [r[0] for r in items.select(share * 100).collect()] == [50.0, 0.0, 100.0]


def test_zero_quantity(spark):
    items = spark.createDataFrame([(0, 50.0), (5, 50.0)], "quantity int, price double")
    flagged = items.filter("quantity = 0")
    assert flagged.count() == 1
    assert flagged.select(F.sum(F.col("quantity") * F.col("price"))).first()[0] == 0


def raw_orders(spark):
    return spark.createDataFrame(
        [
            (1, "10", "2026-02-03 10:00:00"),
            (2, " ", "15-01-2026"),
            (3, None, "soon"),
            (4, "x7", "2026-01-02"),
            (5, "12", None),
        ],
        "order_id long, customer_id string, order_date string",
    )


def test_future_and_unreadable_dates(spark):
    limit = F.lit(datetime(2026, 1, 31)).cast("timestamp_ntz")
    cleaned = flows.clean_raw_orders(raw_orders(spark), limit)
    rows = {r["order_id"]: r for r in cleaned.collect()}
    assert rows[1]["date_in_future"] and not rows[1]["date_reformatted"]
    assert rows[2]["order_date"] == datetime(2026, 1, 15) and rows[2]["date_reformatted"]
    assert rows[3]["date_unparseable"] and rows[3]["order_date"] is None
    assert rows[4]["order_date"] == datetime(2026, 1, 2)
    assert rows[5]["date_unparseable"]
    # A missing customer stays missing; it is flagged instead of given a made-up number.
    assert [rows[i]["customer_id"] for i in range(1, 6)] == [10, None, None, None, 12]
    assert [rows[i]["customer_id_missing_flag"] for i in range(1, 6)] == [False, True, True, False, False]
    found = flows.order_issues(cleaned).groupBy("issue").count().collect()
    assert {r["issue"]: r["count"] for r in found} == {
        "missing_customer_id": 2, "reformatted_date": 4, "unparseable_date": 2, "future_dated_order": 1,
    }


def test_shopping_list(spark):
    rows = [
        ("o1", "A", "tops", "M", 10.0, 2), ("o1", "A", "tops", "M", 10.0, 2),
        ("o2", "B", "tops", "N/A", None, 1), ("o3", "C", "shoes", "", 30.0, None),
        ("o4", "D", "shoes", "L", 21.0, 2),
    ]
    raw = spark.createDataFrame(
        rows, "order_id string, product string, category string, size string, price double, quantity int"
    )
    done = {r["order_id"]: r for r in flows.clean_shopping(raw).collect()}
    assert len(done) == 4
    # Median of 10, 10, 30, 21: the copy counts because fills come first.
    assert done["o2"]["price"] == 15.5 and done["o2"]["size"] == "Unknown"
    assert done["o3"]["quantity"] == 2 and done["o3"]["total_amount"] == 60.0


def test_keys_with_nulls_in_different_places_stay_apart(spark):
    rows = spark.createDataFrame([(None, 5, None), (5, None, None), (5, None, None)], "a int, b int, n int")
    found = validate.violations(rows, ["a", "b"], validate.Constraints(not_null=["n"], unique=[["a", "b"]]))
    assert {(r["rule"], r["row_key"]): r["occurrences"] for r in found.collect()} == {
        ("not_null:n", "<null>|5"): 1, ("not_null:n", "5|<null>"): 2, ("unique:a+b", "5|<null>"): 2,
    }


def test_constraints(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id long")
    rows = spark.createDataFrame(
        [(1, 1, 5), (1, 2, -1), (2, 9, None), (3, None, 4)], "key long, parent long, n int"
    )
    rules = validate.Constraints(
        not_null=["n"], checks={"positive": F.col("n") > 0}, unique=[["key"]],
        references={"parent": (parents, "id")},
    )
    found = {(r["rule"], r["row_key"]): r["occurrences"] for r in validate.violations(rows, ["key"], rules).collect()}
    # An unknown value passes a check and a null reference is not broken, as in SQL.
    assert found == {
        ("not_null:n", "2"): 1, ("check:positive", "1"): 1, ("unique:key", "1"): 2,
        ("references:parent", "2"): 1,
    }
