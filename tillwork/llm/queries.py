"""The registered queries ``opN_<name>`` with production parameters, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm import oracles
from tillwork.llm.alignment import alignment
from tillwork.llm.exact_dedup import exact_dedup
from tillwork.llm.language_id import language_id
from tillwork.llm.mixing import mix, taken
from tillwork.llm.ngram_join import ngram_join
from tillwork.llm.packing import pack
from tillwork.llm.quality_rules import quality
from tillwork.llm.secret_scan import report as secret_report
from tillwork.llm.secret_scan import scan
from tillwork.llm.sharding import assign
from tillwork.llm.sharding import report as shard_report
from tillwork.llm.suffix_dedup import repeated_passages, repeated_spans
from tillwork.llm.texts import documents, embeddings, labels
from tillwork.llm.token_counts import token_counts
from tillwork.llm.toxicity import toxicity
from tillwork.llm.whitening import whiten


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(documents(spark, folder))


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_report(assign(documents(spark, folder)))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return taken(mix(documents(spark, folder)))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(documents(spark, folder), width=3, percent=90)


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_report(scan(documents(spark, folder)))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality(documents(spark, folder))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans(repeated_passages(documents(spark, folder)))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(documents(spark, folder), labels(spark, folder))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(documents(spark, folder))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment(documents(spark, folder))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id(documents(spark, folder))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(embeddings(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    build.__name__: build
    for build in (
        op1_exact_dedup,
        op2_sharding,
        op3_mixing,
        op4_ngram_join,
        op5_secret_scan,
        op6_quality_rules,
        op7_suffix_dedup,
        op8_toxicity,
        op9_token_counts,
        op10_packing,
        op11_alignment,
        op12_language_id,
        op13_whitening,
    )
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": oracles.EXACT_DEDUP,
    "op3_mixing": oracles.MIXING,
    "op4_ngram_join": oracles.NGRAM_JOIN,
    "op5_secret_scan": oracles.SECRETS,
    "op6_quality_rules": oracles.QUALITY,
}
