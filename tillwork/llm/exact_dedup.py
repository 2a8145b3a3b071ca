"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

A text whose length no other text has is unique, and so is one whose (length, prefix) nobody
shares; only the texts left after both tests are hashed in full. The lengths and prefixes that
occur twice reach the scans as a set of hash buckets of fixed number, so the broadcast has a
proven bound and the texts are never shuffled to be filtered. A bucket only lets too much
through: what decides is the SHA-256 of the whole text. All counts are combined on the map
side, so a text that a third of the rows share is one row per task.

Defined results: a missing text equals an empty one. Of equal texts the row with the largest
id stays; a missing id loses against any other. Rows equal in id and text are one document:
all of them are marked kept, and ``keep_one`` leaves one. Very long texts are hashed whole. Columns
of other names are never read. An empty table gives no rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import corpus, matching, wrapped

PREFIX_CHARS = 256
BUCKETS = 1 << 18  # rows of each broadcast at most


def _bucket(key):
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _shared(keys: DataFrame) -> DataFrame:
    """The buckets of the keys that occur more than once: at most BUCKETS rows."""
    twice = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    return F.broadcast(twice.select(_bucket("key").alias("bucket")).distinct())


def _marked(texts: DataFrame) -> DataFrame:
    """``twin``: whether the row agrees with another one in length and in the hash of length and
    prefix. The buckets are joined where the rows are; no text is shuffled."""
    bytes_ = F.octet_length("text").cast("long")
    prefix = F.xxhash64(bytes_, F.substring("text", 1, PREFIX_CHARS))
    same_length = _shared(texts.select(bytes_.alias("key"))).withColumnRenamed("bucket", "its_length")
    sized = texts.join(same_length, _bucket(bytes_) == F.col("its_length"), "left")
    long_enough = sized.filter(F.col("its_length").isNotNull())
    same_prefix = _shared(long_enough.select(prefix.alias("key"))).withColumnRenamed("bucket", "its_prefix")
    met = sized.join(same_prefix, F.col("its_length").isNotNull() & (_bucket(prefix) == F.col("its_prefix")), "left")
    return met.withColumn("twin", F.col("its_prefix").isNotNull()).drop("its_length", "its_prefix")


def copies(texts: DataFrame) -> DataFrame:
    """One row per text that occurs more than once: sha, keep_id, group_size, keep_rows.

    ``keep_rows`` counts the rows that carry ``keep_id``, more than one only for repeated rows.
    """
    hashed = _marked(texts).filter("twin").select("doc_id", F.sha2("text", 256).alias("sha"))
    per_id = hashed.groupBy("sha", "doc_id").agg(F.count("*").alias("n"))
    best = F.max(F.struct("doc_id", "n"))  # nulls sort first
    # A key of its own, so that equal texts are combined again before they are shuffled.
    groups = per_id.groupBy("sha").agg(best.alias("best"), F.sum("n").alias("group_size"))
    return groups.filter("group_size > 1").select(
        "sha",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        F.col("best.n").alias("keep_rows"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of ``docs``."""
    texts = corpus(docs, id_col, text_col)
    rows = texts.select("doc_id", F.sha2("text", 256).alias("sha"))
    groups = copies(texts).withColumnRenamed("sha", "group_sha")
    found = rows.join(groups, matching("sha", "group_sha"), "left")
    keep = F.when(F.col("group_sha").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns."""
    texts = wrapped(docs, id_col, text_col)
    marked = _marked(texts)
    groups = copies(texts.select("doc_id", "text")).withColumnRenamed("sha", "group_sha")
    # Only what may have a copy is hashed and joined; the other rows stay where they are.
    twins = marked.filter("twin").select("doc_id", "row", F.sha2("text", 256).alias("sha"))
    found = twins.join(groups, matching("sha", "group_sha"), "left")
    alone = F.col("group_sha").isNull()
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    once = found.filter(alone | (stays & (F.col("keep_rows") == 1)))
    tied = found.filter(stays & (F.col("keep_rows") > 1)).groupBy("sha").agg(F.first("row").alias("row"))
    unlike = marked.filter(~F.col("twin")).select("row.*")
    return unlike.unionByName(once.select("row.*")).unionByName(tied.select("row.*"))
