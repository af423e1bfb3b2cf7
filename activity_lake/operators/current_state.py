"""Current state per key: the newest event wins, whatever the order of arrival; deletes are dropped afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Broker time first; position breaks ties.
EVENT_ORDER = ("kafka_ts", "kafka_partition", "kafka_offset")


def latest_by_rank(events: DataFrame, keys: Sequence[str], order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Rank 1 of each key, newest first.

    Spark limits each map task to one row per key before the shuffle, so a hot key sends one row per task.
    """
    newest_first = Window.partitionBy(*keys).orderBy(*[F.desc(column) for column in order])
    return events.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") == 1).drop("_rank")


def order_value(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(column) for column in order])


def latest_by_max(events: DataFrame, keys: Sequence[str], order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """The same rows as an aggregate, which Spark also computes partially before the shuffle."""
    rest = [column for column in events.columns if column not in keys]
    newest = F.max_by(F.struct(*rest), order_value(order)).alias("_newest")
    return events.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_newest.`{column}`") for column in rest])


def latest_by_hash(events: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The same rows for a single order column that is never NULL.

    With fixed-width columns this is a hash aggregate, without the two sorts of the other forms. Columns are taken
    one by one, but all from the same row: they see the rows in the same sequence and so agree even on a tie.
    """
    rest = [column for column in events.columns if column not in (*keys, order)]
    newest = [F.max_by(column, order).alias(column) for column in rest]
    return events.groupBy(*keys).agg(*newest, F.max(order).alias(order)).select(*events.columns)


def drop_deleted(rows: DataFrame, flag: str = "is_deleted") -> DataFrame:
    """Rows known not to be deleted. An unknown flag counts as deleted."""
    return rows.filter(~F.col(flag))


def live_events(
    events: DataFrame, keys: Sequence[str], order: Sequence[str] = EVENT_ORDER, flag: str = "is_deleted"
) -> DataFrame:
    """Newest event per key, without the deleted. Filtering first would bring deleted rows back."""
    return drop_deleted(latest_by_rank(events, keys, order), flag)


def count_by(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Rows per key; a NULL key has a group whose count is 0."""
    return rows.groupBy(key).agg(F.count(key).alias(name))


def live_counts(
    bronze: DataFrame, key: str = "id_evenement_sportif", owner: str = "employe_id",
    name: str = "pratique_sportive_annuelle", order: Sequence[str] = EVENT_ORDER, year: int | None = None,
    day: str = "date",
) -> DataFrame:
    """Live activities per owner over the whole history, or those dated in one year."""
    needed = [key, owner, "is_deleted", *order] + ([day] if year is not None else [])
    # Rejected rows have no key and would all meet in one group.
    events = bronze.filter(F.col(key).isNotNull()).select(*dict.fromkeys(needed))
    live = live_events(events, [key], order)
    if year is not None:
        live = live.filter(F.year(day) == year)
    return count_by(live, owner, name)


def grand_total(rows: DataFrame, column: str, name: str = "total") -> DataFrame:
    """Sum of a column, 0 where there is nothing to add."""
    return rows.agg(F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name))
