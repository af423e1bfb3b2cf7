"""Freshness and volume metrics, and how the dashboards read them back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Names of the published metrics.
TOTAL = "pipeline_silver_activites_total"
PEOPLE = "pipeline_silver_employes_total"
UPDATED = "pipeline_silver_last_update_timestamp"

RUN_BATCH, RUN_TOTAL, RUN_ROWS = "silver_run_batch_id", "silver_run_activities", "silver_run_rows_written"


def volume(snapshot: DataFrame, count: str = "pratique_sportive_annuelle") -> DataFrame:
    """One row: activities and rows of a snapshot. Only the count column is read."""
    return snapshot.select(count).agg(*_volume(count))


def _volume(count: str) -> list[Column]:
    return [
        F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("total_activities"),
        F.count(F.lit(1)).alias("total_people"),
    ]


def gauges(snapshot: DataFrame, count: str = "pratique_sportive_annuelle", at: Column | None = None) -> DataFrame:
    """One row per metric: metric, value, at. The snapshot must be a file table, whose file time is the last update."""
    values = snapshot.select(count, "_metadata.file_modification_time").agg(
        *_volume(count), F.unix_millis(F.max("file_modification_time")).alias("last_modified_ms")
    )
    metric = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(column).cast("double").alias("value"))
        for name, column in ((TOTAL, "total_activities"), (PEOPLE, "total_people"), (UPDATED, "last_modified_ms"))
    ])
    stamp = F.current_timestamp() if at is None else at
    return values.select(F.inline(metric)).withColumn("at", stamp)


def run_log(spark: SparkSession, batch_id: int, total: int, rows: int | None) -> DataFrame:
    """What a batch came to, as rows of the metrics table; no row count where nothing was written."""
    values = [(RUN_BATCH, float(batch_id)), (RUN_TOTAL, float(total)), (RUN_ROWS, None if rows is None else float(rows))]
    return spark.createDataFrame(values, "metric string, value double").withColumn("at", F.current_timestamp())


def append_gauges(samples: DataFrame, path: str) -> None:
    samples.write.mode("append").parquet(path)


def last_not_null(samples: DataFrame, metric: str = "metric", value: str = "value", at: str = "at") -> DataFrame:
    """Newest value that is not NULL, per metric. A metric without one is left out."""
    return samples.filter(F.col(value).isNotNull()).groupBy(metric).agg(F.max_by(value, at).alias(value))


def within(samples: DataFrame, now: Column, hours: int = 6, at: str = "at") -> DataFrame:
    """Samples of the last hours up to ``now``."""
    return samples.filter((F.col(at) >= now - F.make_interval(hours=F.lit(hours))) & (F.col(at) <= now))


def series_grid(
    samples: DataFrame, metric: str, value: str, at: str, start: int, end: int, step: int, piece_steps: int = 1_000,
) -> DataFrame:
    """metric, tick, value: the last known value of every series at the ticks start, start + step ... up to ``end``.

    Times are epoch microseconds. A value that is NULL is unknown and does not count; before its first value a series has
    none. Samples before ``start`` count. Every series is cut into pieces of ``piece_steps`` ticks, each computed by
    itself, and each piece hands its last value on to the next: no task holds a whole series, only one row of it per piece.
    """
    width = step * piece_steps
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    # what lies before the grid is in the piece before the first; a sample exactly at a tick counts for it
    piece = F.greatest(F.floor((F.col("_at") - F.lit(start)) / F.lit(width)), F.lit(-1)).cast("bigint")
    known = (samples.filter(F.col(value).isNotNull()).select(F.col(metric).alias(metric), micros.alias("_at"), F.col(value).alias("_value"))
             .filter(F.col("_at") <= end).withColumn("_piece", piece))
    last = known.groupBy(metric, "_piece").agg(F.max_by("_value", "_at").alias("_last"))

    pieces = samples.sparkSession.range(0, max(-(-(end - start + 1) // width), 0)).withColumnRenamed("id", "_piece")
    series = samples.select(metric).distinct()
    # every series has every piece of the grid: a row a piece, not a row a tick
    frame = series.join(F.broadcast(pieces)).unionByName(series.withColumn("_piece", F.lit(-1).cast("bigint")))
    earlier = Window.partitionBy(metric).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    handed = frame.join(last, [metric, "_piece"], "left").select(
        metric, "_piece", F.last("_last", ignorenulls=True).over(earlier).alias("_handed")).filter("_piece >= 0")

    first = F.lit(start) + F.col("_piece") * width
    until = F.least(first + F.lit(width - step), F.lit(end))
    ticks = handed.select(metric, "_piece", "_handed", F.explode(F.sequence(first, until, F.lit(step).cast("bigint"))).alias("_at"))
    # ticks come after the samples of their time
    both = known.select(metric, "_piece", "_at", F.lit(0).alias("_tick"), "_value", F.lit(None).cast(known.schema["_value"].dataType).alias("_handed")
                        ).unionByName(ticks.select(metric, "_piece", "_at", F.lit(1).alias("_tick"),
                                                   F.lit(None).cast(known.schema["_value"].dataType).alias("_value"), "_handed"))
    so_far = Window.partitionBy(metric, "_piece").orderBy("_at", "_tick").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.filter("_piece >= 0").withColumn("_value", F.last("_value", ignorenulls=True).over(so_far))
    return filled.filter("_tick = 1").select(metric, F.col("_at").alias("tick"), F.coalesce("_value", "_handed").alias(value))
