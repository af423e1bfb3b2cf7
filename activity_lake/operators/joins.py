"""Joins of facts and dimensions.

No hint is given: Spark broadcasts what its statistics show to be small and otherwise
shuffles, and its adaptive execution splits hot keys of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.functions.formatting import full_name, or_fallback_name

def with_label(facts: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Inner join to a label table on a shared key column."""
    return facts.join(labels, key, "inner")


def keep_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return rows.filter(F.col(column).isin(*values))


def join_back(rows: DataFrame, results: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Every row, with the result columns of its key or NULL."""
    return rows.join(results.select(key, *columns), key, "left").select(*rows.columns, *columns)


def with_count(rows: DataFrame, counts: DataFrame, key: str, column: str) -> DataFrame:
    """Every row, with the count of its key or 0."""
    return join_back(rows, counts, key, [column]).withColumn(column, F.coalesce(column, F.lit(0)))


def with_lookup(rows: DataFrame, table: DataFrame, key: str, column: str, default: str) -> DataFrame:
    """Every row, with a looked-up text or the default."""
    return join_back(rows, table, key, [column]).withColumn(
        column, F.coalesce(F.col(column).cast("string"), F.lit(default))
    )


def with_person_name(
    events: DataFrame, people: DataFrame, key: str = "employe_id", first: str = "prenom_employe",
    last: str = "nom_employe", name: str = "nom_complet",
) -> DataFrame:
    """Every event, with first and last name of its person or a label made of the key."""
    named = people.select(key, full_name(F.col(first), F.col(last)).alias(name))
    return join_back(events, named, key, [name]).withColumn(name, or_fallback_name(F.col(name), F.col(key)))


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key is given but has no parent."""
    known = parents.select(F.col(parent_key).alias("_parent")).filter(F.col("_parent").isNotNull())
    return rows.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_parent"), "left_anti")


def orphan_keys(rows: DataFrame, parents: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Keys without a parent and how many rows carry each. Counted before the join, so a hot key is one row there."""
    counted = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("orphan_rows"))
    return orphans(counted, parents, key, parent_key)
