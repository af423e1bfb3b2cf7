"""The Silver table: every employee, the checked commute of those with soft mobility, and live activity counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activity_lake.config import MobilityRules
from activity_lake.functions.rules import check_limit, map_category
from activity_lake.operators.joins import keep_values, with_count, with_label
from activity_lake.operators.lookup import DistanceCache, Resolver, lookup_keys

MODE = "moyen_deplacement_id"
LABEL = "nom_moyen_deplacement"
COUNT = "pratique_sportive_annuelle"

# Columns that differ between two runs over the same data.
LINEAGE = ("batch_id", "processing_time")


def soft_mobility(employees: DataFrame, modes: DataFrame, rules: MobilityRules, mode: str = MODE, label: str = LABEL) -> DataFrame:
    """Employees whose mode carries one of the labels, with the label."""
    return keep_values(with_label(employees, modes, mode), label, rules.labels)


def add_lookup_mode(people: DataFrame, rules: MobilityRules, mode: str = MODE) -> DataFrame:
    return people.withColumn("mode", map_category(F.col(mode), rules.lookup_modes))


def resolve_commutes(
    employees: DataFrame, modes: DataFrame, rules: MobilityRules, cache: DistanceCache, resolver: Resolver,
    batch_id: int, parallel_calls: int = 8,
) -> None:
    """Ask for the distances of the employees with soft mobility that are not known yet."""
    people = add_lookup_mode(soft_mobility(employees, modes, rules), rules)
    cache.fill(lookup_keys(people), resolver, batch_id, parallel_calls)


def with_commutes(employees: DataFrame, modes: DataFrame, rules: MobilityRules, cache: DistanceCache) -> DataFrame:
    """All employees, with distance and coherence where the mode is a soft one and the distance is known.

    Other employees keep a NULL lookup mode, which matches nothing, so one pass over the employees does for what
    would be a filter, a check and a join back.
    """
    labels = modes.select(MODE, F.col(LABEL).isin(*rules.labels).alias("_soft"))
    people = add_lookup_mode(employees.join(labels, MODE, "left"), rules)
    people = people.withColumn("mode", F.when(F.col("_soft"), F.col("mode")))
    return cache.add_km(people).withColumn(
        "coherence_distance", check_limit(F.col(MODE), F.col("distance_km"), rules.max_km)
    ).select(*employees.columns, "distance_km", "coherence_distance")


def with_lineage(rows: DataFrame, batch_id: int, at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if at is None else at
    return rows.withColumn("batch_id", F.lit(batch_id)).withColumn("processing_time", stamp)


def silver_table(checked: DataFrame, counts: DataFrame, batch_id: int, at: Column | None = None) -> DataFrame:
    """All employees with their checked commute and their live activities, 0 where there are none."""
    return with_count(with_lineage(checked, batch_id, at), counts, "employe_id", COUNT)
