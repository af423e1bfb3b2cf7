"""Memoised external lookup of commute distances.

The resolver is the caller's function (a web service, a table, a formula). It is called on the executors, for keys
that are not in the cache table yet, once per distinct key, and its answers are appended to the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.functions.rules import metres_to_km
from activity_lake.sinks.compaction import CompactedTable

# address and mode of some keys -> metres, NaN where there is no answer
Resolver = Callable[[pd.DataFrame], pd.Series]

KEY = ("employe_id", "mode", "address_hash")
_CACHE = "employe_id BIGINT, mode STRING, address_hash BIGINT, km DOUBLE, batch_id BIGINT"
_RESOLVED = "employe_id BIGINT, mode STRING, address_hash BIGINT, metres DOUBLE"


def lookup_keys(people: DataFrame, mode: str = "mode", address: str = "adresse") -> DataFrame:
    """Distinct keys to look up. The address is part of the key, so a move of house is a new key."""
    return (
        people.filter(F.col(mode).isNotNull() & F.col(address).isNotNull())
        .select(
            F.col("employe_id").cast("bigint").alias("employe_id"), F.col(mode).alias("mode"),
            F.xxhash64(address).alias("address_hash"), F.col(address).alias("adresse"),
        )
        .dropDuplicates(list(KEY))
    )


def resolve_keys(keys: DataFrame, resolver: Resolver, parallel_calls: int) -> DataFrame:
    """Kilometres of the keys, NULL without an answer, at most ``parallel_calls`` batches at a time."""

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            metres = pd.Series(resolver(batch[["adresse", "mode"]]), dtype="float64")
            yield batch[list(KEY)].assign(metres=metres.to_numpy())

    # Round robin: the keys are distinct already and the calls should be spread evenly.
    answers = keys.repartition(parallel_calls).mapInPandas(call, _RESOLVED)
    return answers.select(*KEY, metres_to_km(F.when(~F.isnan("metres"), F.col("metres"))).alias("km"))


class DistanceCache:
    """Answers given so far, and keys without one, as a Parquet table that only grows.

    A key without an answer is asked for again after ``retry_after`` batches; None means never. ``compact`` rewrites the many
    small files of the batches as few, which readers then use.
    """

    def __init__(self, spark: SparkSession, path: str, retry_after: int | None = 100, min_files: int = 64):
        self._spark = spark
        self._path = path
        self._retry_after = retry_after
        self._compacted = CompactedTable(
            spark, path, f"{path}_compacted", spark.createDataFrame([], _CACHE).schema, min_files)

    def read(self) -> DataFrame:
        """One row per key with its last answer and when it was last asked for; a retried batch may have written twice."""
        return self._compacted.read().groupBy(*KEY).agg(
            F.max_by("km", F.when(F.col("km").isNotNull(), F.col("batch_id"))).alias("km"), F.max("batch_id").alias("asked")
        )

    def compact(self) -> bool:
        """Rewrite the files of past batches, if there are enough of them."""
        return self._compacted.compact()

    def file_count(self) -> int:
        return self._compacted.file_count()

    def missing(self, keys: DataFrame, batch_id: int) -> DataFrame:
        """Keys to ask for in a batch: the new ones, and those whose last try without an answer is long enough ago."""
        settled = F.col("km").isNotNull()
        if self._retry_after is None:
            settled = F.lit(True)
        else:
            settled = settled | (F.col("asked") > batch_id - self._retry_after)
        return keys.join(self.read().filter(settled).select(*KEY), list(KEY), "left_anti")

    def remember(self, answers: DataFrame, batch_id: int) -> None:
        answers.select(*KEY, "km", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("append").parquet(
            self._path
        )

    def fill(self, keys: DataFrame, resolver: Resolver, batch_id: int, parallel_calls: int = 8) -> None:
        """Resolve what is missing. Usually nothing is, and then nothing is written."""
        missing = self.missing(keys, batch_id).persist()
        try:
            if not missing.isEmpty():
                self.remember(resolve_keys(missing, resolver, parallel_calls), batch_id)
        finally:
            missing.unpersist()

    def add_km(self, people: DataFrame, mode: str = "mode", address: str = "adresse", name: str = "distance_km") -> DataFrame:
        """People with their cached distance, NULL where there is none."""
        keyed = people.withColumn("address_hash", F.xxhash64(address))
        found = self.read().drop("asked").withColumnRenamed("mode", mode).withColumnRenamed("km", name)
        return keyed.join(found, ["employe_id", mode, "address_hash"], "left").select(*people.columns, name)
