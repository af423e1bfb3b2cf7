"""From raw documents to the shards of a training mixture: five stages, each written and read again before the next.

1. quality: documents that the classifier and their sites' record call bad go.
2. near_duplicates: of documents linked by five-word shingles at 0.8 or more, one stays.
3. decontamination: documents with long runs of a benchmark item go, short runs are cut out.
4. mixture: documents are taken in copies until every source has its target share of all words.
5. shards: the copies are dealt to shards that all hold the same mixture; shard and slot are added.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from activity_lake.llm import decontamination, jaccard, mixing, quality, sharding
from activity_lake.llm.common import shared_folder, small_batches, table

SHARDS = 8


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs, SHARDS)


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixture", mixed_sources),
    ("shards", sharded),
]

#: SQL can express neither a fitted classifier nor connected components of a similarity join.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table: its columns, whatever their names, with shard and slot added or replaced.

    Null and empty texts have no words: they are judged like other texts, linked with nothing, without leaks, and may be taken
    into the mixture at no cost. A null source is a source of its own. Rows are told apart by id and text together: of rows
    equal in both, null ids included, one stays, while texts that share an id are documents of their own. The mixture takes a
    document up to three times, so ids repeat in the result. An empty table gives no rows.
    """
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
