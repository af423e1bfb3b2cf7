"""Live counts kept up to date batch by batch, equal to a recount of the whole history.

    base/upto=<batch>/bucket=<n>/     newest event per activity
    deltas/batch=<batch>/bucket=<n>/  newest event of each activity a batch touched, and what it counted for before
    counts/batch=<batch>/             live activities per owner after a batch

Buckets are hash ranges of the key, a fixed number of them, so the number of files does not depend on the keys. A batch reads
the state of the activities it touches, and only in the buckets these lie in. Delete markers stay,
so that an older event arriving later cannot revive a deleted activity. When the deltas outgrow a share of the base,
they are folded into a new base, so a row is rewritten a bounded number of times on average.

A batch handed over again reads only what lies before it and overwrites what it wrote, so the result is the same.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.operators.current_state import EVENT_ORDER, latest_by_max, order_value
from activity_lake.sinks.hadoop import HadoopFiles

KEY = "id_evenement_sportif"
OWNER = "employe_id"
COUNT = "pratique_sportive_annuelle"
_STATE = (KEY, OWNER, "is_deleted", "date", *EVENT_ORDER)
# Declared, so that opening the files needs no job to look into them.
_STATE_SCHEMA = (
    f"{KEY} BIGINT, {OWNER} BIGINT, is_deleted BOOLEAN, date TIMESTAMP, kafka_ts TIMESTAMP, kafka_partition INT, kafka_offset BIGINT, "
    "bucket INT"
)
_DELTA_SCHEMA = f"{_STATE_SCHEMA}, old_owner BIGINT, old_live BIGINT"
_COUNT_SCHEMA = f"{OWNER} BIGINT, {COUNT} BIGINT"
_KEPT_COUNTS = 3
_LAST = 1 << 62


class IncrementalCounts:
    """State in ``buckets`` parts, which must stay the same for a root; with ``year`` only activities dated in it count."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = 64, fold_share: float = 0.25, year: int | None = None,
    ):
        self._spark = spark
        self._root = root
        self._files = HadoopFiles(spark, root)
        self._buckets = buckets
        self._year = year
        self._fold_share = fold_share

    # Layout

    def _path(self, folder: str, number: int) -> str:
        label = "upto" if folder == "base" else "batch"
        return f"{self._root}/{folder}/{label}={number}"

    def _complete(self, folder: str, before: int = _LAST) -> list[int]:
        """Batch numbers whose files are all there, in order."""
        found = [re.fullmatch(r"(?:upto|batch)=(\d+)", name) for name in self._files.names(f"{self._root}/{folder}")]
        numbers = sorted(int(match.group(1)) for match in found if match)
        return [
            number for number in numbers
            if number < before and self._files.exists(f"{self._path(folder, number)}/_SUCCESS")
        ]

    def _base_batch(self, before: int) -> int:
        """Last batch in the newest base; -1 without a base."""
        return max(self._complete("base", before), default=-1)

    def _base(self, before: int) -> DataFrame | None:
        upto = self._base_batch(before)
        return self._spark.read.schema(_STATE_SCHEMA).parquet(self._path("base", upto)) if upto >= 0 else None

    def _delta_paths(self, before: int) -> list[str]:
        """Deltas after the base and before a batch."""
        upto = self._base_batch(before)
        return [self._path("deltas", number) for number in self._complete("deltas", before) if number > upto]

    def _deltas(self, before: int) -> DataFrame | None:
        paths = self._delta_paths(before)
        if not paths:
            return None
        return self._spark.read.schema(_STATE_SCHEMA).option("basePath", f"{self._root}/deltas").parquet(*paths)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(self._buckets)).cast("int")

    def _write_buckets(self, rows: DataFrame, path: str) -> None:
        """One file per bucket; a key is in it once."""
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)

    def _live(self) -> Column:
        """1 for a row that counts, else 0."""
        counts = F.col("is_deleted") == F.lit(False)
        if self._year is not None:
            counts = counts & (F.year("date") == self._year)
        return F.when(counts, 1).otherwise(0).cast("bigint")

    # One batch

    def _stored(self, before: int) -> DataFrame | None:
        """All state before a batch, with several rows for some keys."""
        parts = [part for part in (self._base(before), self._deltas(before)) if part is not None]
        rows = [part.select(*_STATE, "bucket") for part in parts]
        return None if not rows else rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])

    def _predecessors(self, touched: DataFrame, batch_id: int) -> DataFrame:
        """State before the batch of the keys it touches."""
        stored = self._stored(batch_id)
        if stored is None:
            return touched.select(*_STATE).limit(0)
        # Folders to read: at most one number per bucket, whatever the batch.
        buckets = touched.select(F.sort_array(F.collect_set(self._bucket())).alias("buckets")).first()["buckets"]
        stored = stored.filter(F.col("bucket").isin(buckets))
        return stored.select(*_STATE).join(touched.select(KEY), KEY, "left_semi")

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take in one micro-batch of Bronze rows."""
        events = batch.filter(F.col(KEY).isNotNull()).select(*_STATE)
        newest = latest_by_max(events, [KEY]).persist()
        try:
            candidates = newest.withColumn("_old", F.lit(False)).unionByName(
                self._predecessors(newest, batch_id).withColumn("_old", F.lit(True))
            )
            state = F.struct(*[column for column in _STATE if column != KEY])
            order = order_value(EVENT_ORDER)
            merged = candidates.groupBy(KEY).agg(
                F.max_by(state, order).alias("now"),
                F.max_by(F.struct(OWNER, self._live().alias("live")), F.when(F.col("_old"), order)).alias("was"),
            )
            self._write_buckets(
                merged.select(
                    KEY, "now.*", F.col(f"was.{OWNER}").alias("old_owner"), F.col("was.live").alias("old_live")
                ),
                self._path("deltas", batch_id),
            )
        finally:
            newest.unpersist()
        self._count(batch_id)
        self._fold_if_due(batch_id)

    # Counts

    def _count(self, batch_id: int) -> None:
        """Counts after the batch: those before it, plus what changed."""
        delta = self._spark.read.schema(_DELTA_SCHEMA).parquet(self._path("deltas", batch_id))
        now = F.struct(F.col(OWNER).alias(OWNER), self._live().alias(COUNT))
        was = F.struct(F.col("old_owner").alias(OWNER), (-F.coalesce("old_live", F.lit(0))).alias(COUNT))
        changes = delta.select(F.inline(F.array(now, was))).filter(f"{COUNT} <> 0 AND {OWNER} IS NOT NULL")
        summed = self.counts(batch_id - 1).unionByName(changes).groupBy(OWNER).agg(F.sum(COUNT).alias(COUNT))
        summed.filter(F.col(COUNT) > 0).write.mode("overwrite").parquet(self._path("counts", batch_id))
        for number in self._complete("counts", batch_id + 1)[:-_KEPT_COUNTS]:
            self._files.delete(self._path("counts", number))

    def counts(self, upto: int | None = None) -> DataFrame:
        """Live activities per owner after a batch, or after the last one taken in."""
        known = self._complete("counts", _LAST if upto is None else upto + 1)
        if known:
            return self._spark.read.schema(_COUNT_SCHEMA).parquet(self._path("counts", known[-1]))
        return self._spark.range(0).select(F.col("id").alias(OWNER), F.col("id").alias(COUNT))

    # Folding

    def _fold_if_due(self, batch_id: int) -> None:
        upto = self._base_batch(batch_id + 1)
        base = self._files.size(self._path("base", upto)) if upto >= 0 else 0
        if sum(map(self._files.size, self._delta_paths(batch_id + 1))) >= self._fold_share * base:
            self.fold(batch_id)

    def fold(self, batch_id: int) -> None:
        """Write a base of everything up to a batch, then drop what only older bases needed."""
        stored = self._stored(batch_id + 1)
        if stored is None or not self._delta_paths(batch_id + 1):
            return
        previous = self._base_batch(batch_id + 1)
        self._write_buckets(latest_by_max(stored.select(*_STATE), [KEY]), self._path("base", batch_id))
        # The previous base and the deltas after it stay: a repeated batch and readers still need them.
        for number in self._complete("base", previous):
            self._files.delete(self._path("base", number))
        for number in self._complete("deltas", previous + 1):
            self._files.delete(self._path("deltas", number))
