"""CSV and Parquet files: readers, writers, lineage, size and gated copies."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark infers one, at the price of another pass."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as text and white space kept, for data that needs cleaning."""
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    return spark.read.option("header", True).options(**options).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """White space is kept, so what is read back equals what was written."""
    options = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).option("header", True).options(**options).csv(path)


def write_report(df: DataFrame, path: str, *order: str) -> None:
    """A sorted CSV. A small result is one file, because Spark merges small partitions."""
    write_csv(df.orderBy(*order), path)


def write_partitioned(df: DataFrame, path: str, *columns: str, mode: str = "errorifexists") -> None:
    """Parquet in one folder per value.

    Rebalancing puts equal values together, so there are few files, and lets AQE split the
    values that are too large for one task.
    """
    df.hint("rebalance", *[F.col(c) for c in columns]).write.mode(mode).partitionBy(*columns).parquet(path)


def with_lineage(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add when and from which file each row came."""
    return df.select(
        "*",
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("_ingested_at"),
        F.col("_metadata.file_name").alias("_source_file"),
    )


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """Name, change time and size of every file below ``path``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("item_name"),
        F.col("modificationTime").alias("last_modified"),
        F.col("length").alias("size"),
    )


def dataset_size(spark: SparkSession, path: str) -> DataFrame:
    return file_facts(spark, path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )


def validated_copy(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Copy a CSV dataset only if it exists and no file of it is empty; return the copy."""
    facts = file_facts(spark, source).agg(F.count("*").alias("files"), F.min("size").alias("least"))
    checked = facts.first()
    if not checked["files"] or not checked["least"]:
        raise ValueError(f"nothing valid to copy in {source}")
    write_csv(read_csv_text(spark, source), target)
    return read_csv_text(spark, target)
