"""The subpackage's queries: each operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from activity_lake.llm import (
    decontamination, html_text, jaccard, knn, language, mixing, phrases, quality, secrets, sharding, suffix_dedup, warc,
    whitening,
)
from activity_lake.llm.common import table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.op1_shards(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op7_mixture(table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.op2_main_text(table(spark, sf_dir, "pages"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.op3_neighbours(table(spark, sf_dir, "embeddings"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.op4_languages(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op5_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.op6_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.op8_archives(table(spark, sf_dir, "pages"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.op9_repeats(table(spark, sf_dir, "documents"))


def op10_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.op10_components(table(spark, sf_dir, "documents"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.op11_secrets(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.op12_whitening(table(spark, sf_dir, "embeddings"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.op13_phrases(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_sharding, op2_main_text, op3_neighbours, op4_language, op5_quality, op6_decontamination, op7_mixing, op8_warc,
        op9_repeats, op10_components, op11_secrets, op12_whitening, op13_phrases, pipeline)
}
#: The others fit models, parse markup, or follow links and byte positions; they are tested against brute force.
LLM_ORACLES: dict[str, str] = {
    "op1_sharding": sharding.ORACLE, "op3_neighbours": knn.ORACLE, "op6_decontamination": decontamination.ORACLE,
    "op7_mixing": mixing.ORACLE, "op8_warc": warc.ORACLE, "op11_secrets": secrets.ORACLE, "op13_phrases": phrases.ORACLE,
    **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
}
