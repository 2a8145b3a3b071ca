"""The local session of tests and benchmark. A cluster's own session is never changed."""

import tempfile

from pyspark.sql import SparkSession

from tillwork.sources.shared import SETTING

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row-level joins leave hot keys to AQE, which splits them at run time. Without "force" it
    # gives up whenever a later operator could reuse the join's partitioning.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, name: str = "tillwork") -> SparkSession:
    """A session for tests and the local benchmark. A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    if not spark.conf.get(SETTING, None):  # one machine: any folder of it is shared
        spark.stop()
        spark = builder.config(SETTING, tempfile.mkdtemp(prefix="tillwork-")).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
