import pytest
from pyspark.sql import functions as F

from tillwork.operators.clean import fill_approx_median, fill_median, fill_mode, require_complete
from tillwork.operators import quantiles
from tillwork.operators.quantiles import exact_quantiles, most_common

POINTS = {"least": 0.0, "q1": 0.25, "median": 0.5, "q77": 0.77, "most": 1.0}


@pytest.fixture(scope="module")
def values(spark):
    hot = F.when(F.rand(1) < 0.33, 7.0).otherwise(F.round(F.rand(2) * 50, 2))
    return spark.range(20000).select(
        "id", hot.alias("hot"), F.randn(3).alias("spread"),
        F.when(F.col("id") < 3, F.col("id") * 1.5).alias("few"), F.lit(None).cast("int").alias("none"),
    ).persist()


def test_quantiles_are_exact(values):
    columns = ["hot", "spread", "few", "none"]
    found = {r["column_name"]: r for r in exact_quantiles(values, columns, POINTS).collect()}
    assert set(found) == {"hot", "spread", "few"}
    for c in found:
        shares = F.array(*[F.lit(p) for p in POINTS.values()])
        expected = values.agg(F.percentile(c, shares)).first()[0]
        assert [found[c][p] for p in POINTS] == pytest.approx(expected, abs=1e-12)


def test_two_heavy_values_around_the_middle(spark):
    rows = spark.createDataFrame([(1.0,)] * 40 + [(2.0,)] * 3 + [(9.0,)] * 40, "v double")
    assert exact_quantiles(rows, ["v"], {"m": 0.5}).first()["m"] == 2.0


def test_nan_and_infinity_do_not_count(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert exact_quantiles(rows, ["v"], {"m": 0.5}).first()["m"] == 2.0


def test_no_values(values):
    assert exact_quantiles(values, ["none"], POINTS).collect() == []


def test_fills(spark):
    rows = spark.createDataFrame(
        [(1, 10.0, 3), (2, None, 5), (3, 40.0, None), (4, 20.0, 5), (5, 31.0, 3)], "id int, p double, q int"
    )
    assert fill_median(rows, "p").filter("id = 2").first()["p"] == 25.5
    # 3 and 5 are equally frequent: the smaller one fills.
    assert fill_mode(rows, "q").filter("id = 3").first()["q"] == 3
    assert fill_approx_median(rows, "q").filter("id = 3").first()["q"] in (3, 5)
    assert most_common(rows, "q").first()["q"] == 3


def test_require_complete(spark):
    rows = spark.createDataFrame([(1,), (None,)], "v int")
    assert require_complete(rows.filter("v is not null"), "v").count() == 1
    with pytest.raises(Exception, match="null in column v"):
        require_complete(rows, "v").collect()


def test_bands_are_narrowed_and_opened_again(values, monkeypatch):
    monkeypatch.setattr(quantiles, "BAND_ROWS", 20)
    monkeypatch.setattr(quantiles, "ACCURACY", 100)
    columns = ["hot", "spread", "few", "none"]
    shares = F.array(*[F.lit(p) for p in POINTS.values()])

    def check():
        found = {r["column_name"]: r for r in exact_quantiles(values, columns, POINTS).collect()}
        assert set(found) == {"hot", "spread", "few"}
        for c in found:
            expected = values.agg(F.percentile(c, shares)).first()[0]
            assert [found[c][p] for p in POINTS] == pytest.approx(expected, abs=1e-12)

    check()
    narrow = quantiles._narrow

    def wrong(df, of, spots):  # a sketch that is far off
        narrow(df, of, spots)
        for k, p in enumerate(spots):
            p.low, p.high = (p.low + 1, p.high + 1) if k % 2 else (p.low - 2, p.low - 1)

    monkeypatch.setattr(quantiles, "_narrow", wrong)
    check()


def test_only_a_band_is_put_in_order(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BAND_ROWS", 1_000)
    found = exact_quantiles(spark.range(1_000_000).select("id"), ["id"], {"m": 0.5})
    assert found.first()["m"] == 499_999.5
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    bands = [p for p in plan.split("\n") if "Window" in p]
    assert len(bands) == 1 and "Generate" in plan
