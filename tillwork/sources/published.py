"""Tables published as folders that are written once.

Each publish writes a folder of its own, under a name that no other attempt uses, and hands on
its path. A failed write leaves nothing that a reader is pointed to, a table can be rewritten
from itself, and whoever holds an older path still reads the older rows.
"""

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tillwork.sources.shared import new_folder

MANIFEST = "manifest.json"


def publish(df: DataFrame, label: str, root: str | None = None, by: tuple[str, ...] = ()) -> str:
    """Write all of ``df`` to a fresh folder, under ``root`` if given, and return its path."""
    path = f"{root}/{label}-{uuid.uuid4().hex}" if root else new_folder(df.sparkSession, label)
    df.write.partitionBy(*by).parquet(path)
    return path


def write_manifest(spark: SparkSession, root: str, content: dict) -> None:
    """Put ``content`` in the place of what the manifest of ``root`` said, in one step: a reader
    finds either the old or the new one."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target, draft = hadoop.Path(f"{root}/{MANIFEST}"), hadoop.Path(f"{root}/draft-{uuid.uuid4().hex}")
    out = target.getFileSystem(conf).create(draft, False)
    out.write(bytearray(json.dumps(content, indent=1).encode()))
    out.close()
    kind = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    # A path without scheme is one of the default file system.
    where = target.getFileSystem(conf).makeQualified(target)
    hadoop.FileContext.getFileContext(where.toUri(), conf).rename(draft.getFileSystem(conf).makeQualified(draft), where, options)


def read_manifest(spark: SparkSession, root: str) -> dict:
    return json.loads(spark.read.text(f"{root}/{MANIFEST}", wholetext=True).first()[0])


def append(df: DataFrame, path: str) -> str:
    """Add the rows of ``df`` as new files; those already there are not touched."""
    df.write.mode("append").parquet(path)
    return path
