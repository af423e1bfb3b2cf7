"""Decode change events from topic rows. One projection: no shuffle, no Python worker, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from activity_lake.functions.decimals import decode_decimal
from activity_lake.functions.formatting import epoch_micros
from activity_lake.schemas import CHANGE_VALUE, bronze_schema

_BAD_JSON = "_bad_json"
_PARSED = T.StructType([*CHANGE_VALUE.fields, T.StructField(_BAD_JSON, T.StringType())])


def drop_tombstones(topic: DataFrame) -> DataFrame:
    return topic.filter(F.col("value").isNotNull())


def parse_changes(topic: DataFrame) -> DataFrame:
    """Fields of the JSON value, the broker's time and position, and the text itself where it could not be parsed.

    The parsed struct becomes columns through a generator: a filter on them is not pushed below it, so that the text
    is parsed once and not once more for the filter.
    """
    parsed = F.from_json("json_text", _PARSED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD_JSON})
    return (
        drop_tombstones(topic)
        .select(
            F.col("value").cast("string").alias("json_text"),
            F.col("timestamp").alias("kafka_ts"),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
        )
        .select(F.inline(F.array(parsed)), "json_text", "kafka_ts", "kafka_partition", "kafka_offset")
    )


def to_bronze(topic: DataFrame, precision: int = 10, scale: int = 0) -> DataFrame:
    """Bronze rows. A row that lost something says why in ``reject_reason`` and keeps its text in ``raw_value``.

    Without a key a row cannot be counted; with a bad date or distance only that field is NULL.
    """
    decoded = parse_changes(topic).select(
        "*",
        epoch_micros(F.col("date")).alias("_micros"),
        decode_decimal(F.col("distance.value"), F.col("distance.scale"), precision, scale).alias("distance_km"),
        (F.col("__deleted") == "true").alias("is_deleted"),
    )
    # A blank text is no JSON either, but the parser does not report it.
    unparsed = F.col(_BAD_JSON).isNotNull() | (F.trim("json_text") == "")
    reason = (
        F.when(F.col("id_evenement_sportif").isNull() & unparsed, "bad_json")
        .when(F.col("id_evenement_sportif").isNull(), "no_key")
        .when(F.col("date").isNotNull() & F.col("_micros").isNull(), "bad_date")
        .when(F.col("distance.value").isNotNull() & F.col("distance_km").isNull(), "bad_distance")
        .when(F.col(_BAD_JSON).isNotNull(), "bad_field")
    )
    return decoded.withColumn("reject_reason", reason).select(
        "id_evenement_sportif", "employe_id", "type_pratique_sportive",
        F.timestamp_micros("_micros").alias("date"),
        "temps_ecoule", "commentaire", "is_deleted", "kafka_ts", "distance_km", "kafka_partition", "kafka_offset",
        "reject_reason", F.when(F.col("reject_reason").isNotNull(), F.col("json_text")).alias("raw_value"),
    )


def keyed_events(bronze: DataFrame) -> DataFrame:
    """The events that name an activity."""
    return bronze.filter(F.col("id_evenement_sportif").isNotNull())


def rejects(bronze: DataFrame) -> DataFrame:
    """The reject table; on Parquet the filter skips the row groups that have none."""
    return bronze.filter(F.col("reject_reason").isNotNull()).select(
        "reject_reason", "raw_value", "kafka_ts", "kafka_partition", "kafka_offset"
    )


def reject_counts(bronze: DataFrame) -> DataFrame:
    return rejects(bronze).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rejected"))


BRONZE_COLUMNS = tuple(bronze_schema().fieldNames())
