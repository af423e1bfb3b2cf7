"""Topic-shaped input: rows of value, timestamp, partition and offset.

The message broker is one format among others. Parquet files of the same four columns are read the same way, which
is how streams are tested and how an archived topic is replayed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from activity_lake.schemas import TOPIC

TOPIC_COLUMNS = tuple(TOPIC.fieldNames())


def broker_options(
    servers: str, topics: Sequence[str] = (), pattern: str | None = None, starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the broker source: an explicit list of topics, or a pattern that selects them.

    ``starting`` is ``earliest`` for a full replay or ``latest`` to tail; after the first start the checkpoint decides.
    """
    if bool(topics) == bool(pattern):
        raise ValueError("give either topics or a pattern")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting}
    options.update({"subscribe": ",".join(topics)} if topics else {"subscribePattern": pattern})
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def stream_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load().select(*TOPIC_COLUMNS)


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("kafka").options(**options).load().select(*TOPIC_COLUMNS)


def stream_topic_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """An archived topic as a stream of Parquet files."""
    reader = spark.readStream.schema(TOPIC)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
