"""A lake that other sessions find, and product versions of which only the current ones are rewritten."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tillwork.operators import scd2
from tillwork.operators.medallion import BY_STATE, Lake
from tillwork.sources.shared import new_folder

DAYS = [date(2024, m, 1) for m in (1, 3, 5, 7)]


@pytest.fixture()
def lake(spark):
    products = spark.createDataFrame([(k, f"p{k}", float(k)) for k in range(1, 6)], "product_id long, name string, price double")
    lake = Lake(spark, new_folder(spark, "lake"))
    lake._publish("silver", "products", scd2.init(products, DAYS[0]), BY_STATE)
    return lake


def prices(spark, *rows):
    return spark.createDataFrame(list(rows), "product_id long, price double")


def versions(lake, key):
    rows = scd2.history(lake.read("silver", "products"), "product_id", key).collect()
    return [(r["price"], r["effective_date"], r["end_date"], r["is_current"]) for r in rows]


def test_a_batch_writes_current_rows_and_those_that_end(spark, lake):
    lake.reprice(prices(spark, (1, 1.5), (2, 2.5)), DAYS[1])
    lake.reprice(prices(spark, (1, 1.7)), DAYS[2])
    *_, newest = lake.tables["silver/products"]["folders"]
    written = spark.read.parquet(newest)
    assert written.count() == 6  # five current ones and the one that ended
    assert lake.read("silver", "products").count() == 8
    assert versions(lake, 1) == [
        (1.0, DAYS[0], DAYS[1], False), (1.5, DAYS[1], DAYS[2], False), (1.7, DAYS[2], None, True),
    ]
    assert versions(lake, 2) == [(2.0, DAYS[0], DAYS[1], False), (2.5, DAYS[1], None, True)]
    assert scd2.current(lake.read("silver", "products")).count() == 5


def test_a_late_change_rewrites_all_versions(spark, lake):
    lake.reprice(prices(spark, (1, 1.5)), DAYS[2])
    lake.reprice(prices(spark, (1, 1.2), (3, 3.3)), DAYS[1])
    assert len(lake.tables["silver/products"]["folders"]) == 1
    assert versions(lake, 1) == [
        (1.0, DAYS[0], DAYS[1], False), (1.2, DAYS[1], DAYS[2], False), (1.5, DAYS[2], None, True),
    ]
    assert versions(lake, 3) == [(3.0, DAYS[0], DAYS[1], False), (3.3, DAYS[1], None, True)]


def test_another_session_reads_what_was_committed_last(spark, lake):
    lake.commit()
    lake.reprice(prices(spark, (1, 9.0)), DAYS[1])
    other = Lake.opened(spark.newSession(), lake.root)
    assert versions(other, 1) == [(1.0, DAYS[0], None, True)]
    with pytest.raises(Exception, match="broken"):
        broken = prices(spark, (2, 8.0)).withColumn("price", F.raise_error(F.lit("broken")).cast("double"))
        lake.reprice(broken, DAYS[3])
    assert versions(Lake.opened(spark, lake.root), 1) == [(1.0, DAYS[0], None, True)]
    lake.commit()
    assert [v[0] for v in versions(Lake.opened(spark.newSession(), lake.root), 1)] == [1.0, 9.0]
    assert versions(other, 1) == [(1.0, DAYS[0], None, True)]  # an older reader keeps its rows


def test_an_empty_table(spark, lake):
    lake._publish("silver", "products", lake.read("silver", "products").limit(0), BY_STATE)
    lake.reprice(prices(spark, (1, 1.0)), DAYS[1])
    assert lake.read("silver", "products").isEmpty()
