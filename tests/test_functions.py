from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwork.functions import dates, money, text


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@given(st.lists(st.text(alphabet="abcXYZéß '-0129_./&", max_size=12), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_title_case_is_pythons(spark, words):
    words = [w for w in words if "ß" not in w]  # its capital has two letters
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    found = [r[0] for r in rows.orderBy("i").select(text.title_case(F.col("w"))).collect()]
    assert found == [w.title() for w in words]


def test_title_case_examples(spark):
    rows = spark.createDataFrame([("  t-shirt over-ear LED ",), (None,)], "w string")
    found = [r[0] for r in rows.select(text.title_case(text.squeeze(F.col("w")))).collect()]
    assert found == ["T-Shirt Over-Ear Led", None]


@pytest.mark.parametrize(
    "value, expected",
    [("12.0", 12), ("NA", None), ("", None), ("7", 7), (" 8 ", 8), (None, None)],
)
def test_to_integer(spark, value, expected):
    assert one(spark, text.to_integer(F.lit(value).cast("string"))) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("a@b.co", True), ("a.b.co", False), ("a@b", False), ("a b@c.d", False), (None, False), ("a@b@c.d", False)],
)
def test_is_email(spark, value, expected):
    assert one(spark, text.is_email(F.lit(value).cast("string"))) is expected


def test_missing_tokens_and_names(spark):
    rows = spark.createDataFrame([("N/A",), ("  ",), ("NaN",), ("Large",)], "s string")
    assert [r[0] for r in rows.select(text.tokens_to_null(F.col("s"))).collect()] == [None, None, None, "Large"]
    assert one(spark, text.canonical(F.lit(" CLOTHS "), text.CATEGORY_NAMES)) == "Clothing"
    assert one(spark, text.canonical(F.lit("Toys"), text.CATEGORY_NAMES)) == "Toys"


def test_money_is_exact(spark):
    rows = spark.createDataFrame(
        [(0.1, 0.5)] * 10 + [(-2.25, 0.1), (None, 0.1), (1e12, 0.0), (float("nan"), 0.0)], "p double, d double"
    )
    found = rows.select(
        money.amount(money.revenue_sum("p", "d"), 4), money.amount(money.money_sum("p")), money.money_mean("p")
    ).first()
    assert found[0] == 999999999998.475 and found[1] == 999999999998.75
    assert found[2] == Decimal("83333333333.229167")
    assert [r[0] for r in rows.select(money.revenue("p", "d")).collect()][9:12] == [0.05, -2.03, None]
    assert rows.filter("p is null").select(money.money_sum("p")).first()[0] is None
    # Sums hold more than a long of cents.
    huge = spark.createDataFrame([(9e15,)] * 500, "p double").select(money.money_sum("p")).first()[0]
    assert huge == Decimal("4500000000000000000.00")
    assert one(spark, money.percent_change(F.lit(0), F.lit(5))) is None
    assert one(spark, money.percent(F.lit(1), F.lit(3))) == 33.33


def test_money_rounds_by_one_rule_in_lines_and_totals(spark):
    for value, cents in [(1.005, 1.01), (-0.125, -0.13), (261.965, 261.97), (-1.005, -1.01), (0.115, 0.12), (2.5, 2.5)]:
        rows = spark.createDataFrame([(value, 0.0)], "p double, d double")
        total = rows.agg(money.money_sum("p"), money.revenue_sum("p", "d")).first()
        assert [float(x) for x in total] == [cents, cents]
        assert rows.select(money.revenue("p", "d"), money.money("p").cast("double")).first() == (cents, cents)


@pytest.mark.parametrize("value", [1e17, float("inf"), -3e300])
def test_amounts_out_of_range_raise(spark, value):
    rows = spark.createDataFrame([(value,), (value,)], "p double")
    with pytest.raises(Exception, match="out of range|OVERFLOW|overflow"):
        rows.agg(money.money_sum("p")).collect()


def test_large_months_have_a_mean(spark):
    months = spark.createDataFrame([(1e13,), (3e13,)], "p double").agg(money.money_sum("p").alias("s"), F.count("*").alias("n"))
    assert months.select(money.ratio(F.col("s"), F.col("n"))).first()[0] == 2e13


def test_periods(spark):
    def found(kind, day):
        start, end = dates.period(kind, F.lit(day))
        return spark.range(1).select(start, end, *dates.preceding(start, end)).first()

    assert found("daily", date(2024, 2, 29)) == (*(date(2024, 2, 29),) * 2, *(date(2024, 2, 28),) * 2)
    assert found("weekly", date(2024, 2, 29))[:2] == (date(2024, 2, 26), date(2024, 3, 3))
    assert found("monthly", date(2024, 2, 10))[:2] == (date(2024, 2, 1), date(2024, 2, 29))
    assert found("monthly", date(2023, 12, 31))[:2] == (date(2023, 12, 1), date(2023, 12, 31))
    with pytest.raises(ValueError):
        dates.period("yearly", F.lit(date(2024, 1, 1)))
    # Equal length, not the calendar month before.
    assert found("monthly", date(2024, 3, 5))[2:] == (date(2024, 1, 30), date(2024, 2, 29))


def test_intervals(spark):
    day = lambda d: F.lit(d).cast("date")
    assert one(spark, dates.elapsed_days(day("2024-01-01"), day("2024-01-04"))) == 3
    assert one(spark, dates.elapsed_days(day("2024-01-04"), day("2024-01-01"))) is None
    assert one(spark, dates.months_between(day("2023-11-30"), day("2024-02-01"))) == 3
