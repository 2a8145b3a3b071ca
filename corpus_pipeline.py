"""From raw documents to packed sequences, in stages that each write and read whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from tillwork.llm.texts import documents, pin


def _recounted(docs: DataFrame) -> DataFrame:
    """Texts that were cut have other lengths."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose their bad lines."""
    return _recounted(quality_rules.cleaned(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles and a similarity of 0.8 the least id stays."""
    return ngram_join.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return _recounted(mixing.mixed_documents(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact_copies),
    ("near duplicates", near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

# Not given: the dynamic program of packing and the tokenizer have no SQL. The stages are tested
# against brute force instead (tests/llm/test_pipeline.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
