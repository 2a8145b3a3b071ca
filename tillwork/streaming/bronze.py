"""Incremental landing of new files into bronze."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def land_new_files(spark: SparkSession, source: str, schema: str, target: str, progress: str) -> DataFrame:
    """Append the files that arrived since the last run, each exactly once, and stop.

    ``progress`` is the checkpoint folder; it and ``target`` must be shared storage. The
    number of files per micro-batch is bounded, so a large backlog is landed in steps.
    """
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000).parquet(source)
    rows = files.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.col("_metadata.file_name").alias("_source_file"),
    )
    stream = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return spark.read.parquet(target)
