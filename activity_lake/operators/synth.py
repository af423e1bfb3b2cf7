"""Synthetic activities for existing employees: a pure function of a seed and the number of the activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.config import COMMENTS, DAYS, FIRST_DAY, KM_RANGE, SECONDS_RANGE, SPORTS
from activity_lake.operators.keys import with_next_keys


def _draw(start: int, digits: int, bound: Column | int) -> Column:
    """Number from 0 to bound - 1 out of some hexadecimal digits of the row's hash."""
    bound = F.lit(bound) if isinstance(bound, int) else bound
    return F.pmod(F.conv(F.substring("_hash", start, digits), 16, 10).cast("bigint"), bound)


def _between(start: int, limits: tuple[int, int]) -> Column:
    return _draw(start, 8, limits[1] - limits[0] + 1) + limits[0]


def _pick(start: int, values: Sequence[str]) -> Column:
    choices = F.array(*[F.lit(value) for value in values])
    return F.element_at(choices, (_draw(start, 8, len(values)) + 1).cast("int"))


def synthetic_activities(employees: DataFrame, activities: DataFrame, seed: int, key: str = "employe_id") -> DataFrame:
    """One activity per row of ``activities`` (a column ``id`` from 1), for an employee drawn at random.

    Sport, whole kilometres, day and seconds are uniform in the declared ranges.
    """
    none = employees.sparkSession.range(0).withColumnRenamed("id", "_number")
    numbered = with_next_keys(employees.select(key), none, "_number", [key])
    people = numbered.count()
    drawn = activities.select(
        F.col("id").alias("id_evenement_sportif"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).alias("_hash"),
    ).select(
        "id_evenement_sportif", "_hash",
        # Never NULL, and said so: else the join filters on the key and hashes each row twice.
        F.coalesce(_draw(1, 15, people) + 1, F.lit(0)).alias("_number"),
    )
    return drawn.join(numbered, "_number").select(
        "id_evenement_sportif", key,
        _pick(16, SPORTS).alias("type_pratique_sportive"),
        F.date_add(F.lit(FIRST_DAY).cast("date"), _draw(32, 8, DAYS).cast("int")).alias("date"),
        _between(24, KM_RANGE).alias("distance"),
        _between(40, SECONDS_RANGE).alias("temps_ecoule"),
        _pick(48, COMMENTS).alias("commentaire"),
    )
