from pyspark.sql import functions as F
import pytest

from tillwork.sources import files
from tillwork.sources.published import append, publish
from tillwork.sources.shared import new_folder, pin, shared_dir
from tillwork.sources.tables import SCHEMAS
from tillwork.streaming.bronze import land_new_files


def test_a_table_can_rewrite_itself_and_older_paths_stay(spark):
    first = publish(spark.range(3).toDF("id"), "t")
    second = publish(spark.read.parquet(first).withColumn("id", F.col("id") * 10), "t")
    files_before = set(spark.read.parquet(second).inputFiles())
    append(spark.range(1).toDF("id"), second)
    ids = lambda path: sorted(r["id"] for r in spark.read.parquet(path).collect())
    assert ids(first) == [0, 1, 2] and ids(second) == [0, 0, 10, 20]
    assert files_before < set(spark.read.parquet(second).inputFiles())


def test_a_failed_publish_is_followed_by_a_good_one(spark):
    good = publish(spark.range(3), "t")
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, "t")
    assert spark.read.parquet(publish(spark.read.parquet(good), "t")).count() == 3


def test_csv_keeps_white_space_and_types(spark, tables):
    path = new_folder(spark, "csv")
    rows = spark.createDataFrame([("  padded ", 1.25), ('quote " and, comma', -3.0)], "s string, d double")
    files.write_csv(rows, path)
    assert files.read_csv_text(spark, path).filter("s = '  padded '").count() == 1
    assert files.read_csv(spark, path, "s string, d double").agg(F.sum("d")).first()[0] == -1.75


def test_partitioned_parquet_prunes(spark, tables):
    path = new_folder(spark, "by-status")
    files.write_partitioned(tables.orders, path, "o_orderstatus")
    chosen = spark.read.parquet(path).filter("o_orderstatus = 'F'")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(o_orderstatus" in plan
    assert chosen.count() == tables.orders.filter("o_orderstatus = 'F'").count()


def test_copy_only_what_is_valid(spark):
    source, target = new_folder(spark, "src"), new_folder(spark, "dst")
    with pytest.raises(Exception):
        files.validated_copy(spark, source, target)
    files.write_csv(spark.range(5), source)
    assert files.validated_copy(spark, source, target).count() == 5
    facts = files.file_facts(spark, source).collect()
    assert all(f["size"] > 0 and f["item_name"].endswith(".csv") for f in facts)
    size = files.dataset_size(spark, source).first()
    assert size["bytes"] == sum(f["size"] for f in facts)


def test_reports_are_sorted_and_whole(spark):
    path = new_folder(spark, "report")
    files.write_report(spark.range(1000).select((999 - F.col("id")).alias("n")), path, "n")
    back = files.read_csv(spark, path, "n long").groupBy(F.input_file_name().alias("f"))
    ranges = back.agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("k")).orderBy("f").collect()
    assert [r["low"] for r in ranges] == [0, *[r["high"] + 1 for r in ranges[:-1]]]
    assert sum(r["k"] for r in ranges) == 1000


def test_release_removes_what_this_application_pinned(spark):
    from tillwork.sources import shared

    before = shared._WORKSPACES.pop(spark.sparkContext.applicationId, None)
    try:
        folder = pin(spark.range(5)).inputFiles()[0]
        shared.release(spark)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    finally:
        if before:
            shared._WORKSPACES[spark.sparkContext.applicationId] = before


def test_pinned_rows_do_not_change(spark):
    random = spark.range(100).select(F.rand().alias("r"))
    pinned = pin(random)
    assert pinned.exceptAll(pinned).isEmpty()
    assert f"{shared_dir(spark).removeprefix('file:').lstrip('/')}/tillwork/" in pinned.inputFiles()[0]


def test_new_files_land_once(spark, tables):
    source, target, progress = (new_folder(spark, n) for n in ("in", "bronze", "progress"))
    tables.region.write.parquet(source)
    assert land_new_files(spark, source, SCHEMAS["region"], target, progress).count() == 5
    assert land_new_files(spark, source, SCHEMAS["region"], target, progress).count() == 5
    tables.region.write.mode("append").parquet(source)
    assert land_new_files(spark, source, SCHEMAS["region"], target, progress).count() == 10
