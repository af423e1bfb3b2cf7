"""Surrogate keys for new rows."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from activity_lake.session import ensure_checkpoint_dir
from activity_lake.sinks.hadoop import HadoopFiles
from activity_lake.sources.relational import max_key


class KeyRanges:
    """Ranges of keys that several writers take from one log.

    Claim number n is a file that can be created once: the writer that creates it has the range behind claim n - 1, any other
    one tries for the next. Ranges are unique and without gaps whatever the order in which the writers then write.
    """

    def __init__(self, spark: SparkSession, root: str, highest: int = 0):
        self._root = root
        self._files = HadoopFiles(spark, root)
        self._highest = highest

    def claims(self) -> list[tuple[int, int]]:
        """First key and number of keys of every claim, in order."""
        names = [name for name in self._files.names(self._root) if name.isdigit()]
        return [tuple(map(int, self._files.read_text(f"{self._root}/{name}").split())) for name in names]

    def claim(self, count: int) -> int:
        """Take the next ``count`` keys; returns the first."""
        while True:
            taken = [name for name in self._files.names(self._root) if name.isdigit()]
            start = self._highest + 1
            if taken:
                text = self._files.read_text(f"{self._root}/{taken[-1]}")
                if not text:  # its writer has created it and not filled it yet
                    time.sleep(0.01)
                    continue
                first, had = map(int, text.split())
                start = first + had
            if self._files.create_text(f"{self._root}/{len(taken):012d}", f"{start} {count}"):
                return start


def with_next_keys(rows: DataFrame, existing: DataFrame, key: str, order: Sequence[str], partitions: int | None = None,
                   ranges: KeyRanges | None = None) -> DataFrame:
    """New rows numbered after the highest existing key, in the stated order, without gaps.

    With ``ranges`` the numbers are those of a range claimed for these rows, so that several writers can number at a time.

    ``order`` should identify a row. The rows are range-partitioned by it, so that each partition is numbered by its
    own task; the start of a partition comes from the row counts of those before it.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(count, *order).sortWithinPartitions(*order)
    # Partition in the upper bits, position in the lower 33. Written out, because both passes below must see the
    # same partitions even if an executor is lost in between.
    placed = ranged.withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_place", 33)
    position = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))

    # One row per partition from here on, so the unpartitioned window and the broadcast stay small.
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    highest = max_key(existing, key).first()["max_key"] if ranges is None else ranges.claim(placed.count()) - 1
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(key, F.lit(highest) + F.col("_start") + position + 1)
        .select(key, *[column for column in rows.columns if column != key])
    )
