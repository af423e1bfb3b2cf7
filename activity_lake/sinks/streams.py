"""Streaming sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from activity_lake.config import TRIGGER_INTERVAL


def with_trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """A micro-batch per interval; None drains what is there and stops (tests and backfills)."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def append_parquet(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER_INTERVAL,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to Parquet; the sink's log and the checkpoint make each row appear once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, interval).start(path)


def each_batch(
    stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
    interval: str | None = TRIGGER_INTERVAL,
) -> StreamingQuery:
    """Call a handler per micro-batch. A batch may be handed over again after a failure, under the same id."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return with_trigger(writer, interval).start()


def as_topic_rows(rows: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as one JSON message, keyed where a key column is named."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    return rows.select(value) if key is None else rows.select(F.col(key).cast("string").alias("key"), value)


def write_topic(rows: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    writer = as_topic_rows(rows, key).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
