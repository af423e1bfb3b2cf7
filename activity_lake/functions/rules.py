"""Rules that depend on parameters: limits per category, levels by step, percentages, unit changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

OK = "OK"
ERROR = "ERREUR"


def metres_to_km(metres: Column) -> Column:
    return metres / 1000


def map_category(category: Column, mapping: Mapping[int, str]) -> Column:
    """The text mapped to a category, NULL for any other category."""
    result = F.lit(None).cast("string")
    for key, text in mapping.items():
        result = F.when(category == key, F.lit(text)).otherwise(result)
    return result


def check_limit(category: Column, value: Column, limits: Mapping[int, float]) -> Column:
    """OK up to and including the limit of the category, ERREUR above; NULL without a limit or a value."""
    limit = F.lit(None).cast("double")
    for key, bound in limits.items():
        limit = F.when(category == key, F.lit(float(bound))).otherwise(limit)
    return F.when(value <= limit, F.lit(OK)).when(value > limit, F.lit(ERROR))


def level(value: Column, steps: Sequence[tuple[str, float]]) -> Column:
    """Name of the highest step reached. Below the first step, the first name; NULL stays NULL."""
    ordered = sorted(steps, key=lambda step: step[1])
    result = F.lit(ordered[0][0])
    for name, start in ordered[1:]:
        result = F.when(value >= start, F.lit(name)).otherwise(result)
    return F.when(value.isNotNull(), result)


def percent_used(available: Column, total: Column) -> Column:
    """(1 - available / total) * 100, NULL for a zero total."""
    return (F.lit(1.0) - F.try_divide(available, total)) * 100
