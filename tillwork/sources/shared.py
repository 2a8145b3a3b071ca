"""The folder every executor can reach, and tables pinned in it."""

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_WORKSPACES: dict[str, str] = {}
_TABLES: dict[str, list[str]] = {}
MOST_BUCKETS = 100_000  # that Spark allows a table


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. There is no fallback to a folder of one machine."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return folder.rstrip("/")


def workspace(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    application = spark.sparkContext.applicationId
    if application not in _WORKSPACES:
        _WORKSPACES[application] = f"{shared_dir(spark)}/tillwork/{application}-{uuid.uuid4().hex}"
    return _WORKSPACES[application]


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Remove everything this application has pinned or landed so far.

    Frames that still read it fail afterwards, so this is for the end of an application, or of
    a job whose result has been written elsewhere.
    """
    for name in _TABLES.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    folder = _WORKSPACES.pop(spark.sparkContext.applicationId, None)
    if folder:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pin(df: DataFrame, label: str = "pinned") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, so several uses see the same rows in the same layout even when an
    executor is lost, and none of them recomputes the input. The copy stays until ``release``.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pin_bucketed(df: DataFrame, column: str, buckets: int, label: str = "bucketed") -> DataFrame:
    """Like ``pin``, in a table whose files are bucketed by ``column``: what groups by it or is a
    window over it reads the table without a shuffle. The table is external, in the shared
    folder; ``release`` drops it."""
    spark = df.sparkSession
    path, name = new_folder(spark, label), f"tillwork_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", path).bucketBy(min(buckets, MOST_BUCKETS), column)
    writer.saveAsTable(name)
    _TABLES.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)
