"""The star-schema test tables put in the roles of the pipeline: events as a change stream, customers as employees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from activity_lake.functions.decimals import encode_integer

# Segments in the role of soft transport modes, with the name the lookup uses and the limit in km.
SOFT_SEGMENTS = {"MACHINERY": ("walking", 5.0), "BUILDING": ("bicycling", 15.0)}

DELETE_TYPE = "error"
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream. The pattern matches a single file as well as a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def micros(column: str) -> Column:
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, {column})")


def prop_k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def event_key() -> Column:
    """An activity key that several events share: the user and the property k (below 100)."""
    return F.col("user_id") * 100 + prop_k()


def keyed_state(events: DataFrame) -> DataFrame:
    """Events as change rows of few, fixed-width columns."""
    return events.select(
        event_key().alias("id_evenement_sportif"), F.col("user_id").alias("employe_id"),
        (F.col("event_type") == DELETE_TYPE).alias("is_deleted"), "ts",
    )


def as_topic(
    events: DataFrame, key: Column | None = None, owner: Column | None = None, date: Column | None = None,
) -> DataFrame:
    """Events encoded as topic rows: JSON with epoch microseconds, a base64 decimal of scale 2 and a delete marker."""
    value = F.struct(
        (F.col("event_id") if key is None else key).alias("id_evenement_sportif"),
        (F.col("user_id") if owner is None else owner).alias("employe_id"),
        F.col("event_type").alias("type_pratique_sportive"),
        (micros("ts") if date is None else date).alias("date"),
        F.struct(F.lit(2).alias("scale"), encode_integer(cents()).alias("value")).alias("distance"),
        (prop_k() * 97).alias("temps_ecoule"),
        F.col("props").alias("commentaire"),
        F.when(F.col("event_type") == DELETE_TYPE, "true").otherwise("false").alias("__deleted"),
    )
    row = F.struct(
        F.to_json(value).cast("binary").alias("value"),
        F.timestamp_micros(micros("ts")).alias("timestamp"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    # Through a generator, so that a later filter does not encode the row a second time.
    return events.select(F.inline(F.array(row)))
