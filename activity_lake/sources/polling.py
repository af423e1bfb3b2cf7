"""Polling: read a whole table at intervals and send on each row in an envelope."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from activity_lake.config import POLL_INTERVAL


def with_envelope(rows: DataFrame, source: str, at: Column | None = None) -> DataFrame:
    """Each row with a nested ``metadata`` of where and when it was read."""
    stamp = F.current_timestamp() if at is None else at
    return rows.withColumn("metadata", F.struct(F.lit(source).alias("source"), stamp.alias("ts")))


def start_polling(
    spark: SparkSession, read: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], source: str,
    checkpoint: str, interval: str = POLL_INTERVAL,
) -> StreamingQuery:
    """Poll for ever: a rate stream is only the clock, the rows come from ``read``."""

    def poll(_: DataFrame, batch_id: int) -> None:
        write(with_envelope(read(), source), batch_id)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        clock.writeStream.foreachBatch(poll).option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval).start()
    )
