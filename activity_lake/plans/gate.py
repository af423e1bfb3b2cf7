"""The change gate: whether a recomputed table is worth writing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activity_lake.operators.current_state import grand_total

MODES = ("total", "fingerprint")


def fingerprint(table: DataFrame, total: str, ignore: Sequence[str] = ()) -> DataFrame:
    """One row that does not depend on row order: rows, sum of the total column, sum of row hashes."""
    columns = [F.col(column) for column in sorted(table.columns) if column not in ignore]
    # The hash skips NULLs, so where they are is hashed as well.
    row_hash = F.xxhash64(*columns, *[column.isNull() for column in columns])
    return table.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total"),
        F.coalesce(F.sum(row_hash.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("row_hash"),
    )


def total_of(table: DataFrame, column: str) -> int:
    return grand_total(table, column).first()["total"]


def is_changed(
    new: DataFrame, old: DataFrame | None, total: str, mode: str = "total", ignore: Sequence[str] = (),
    new_total: int | None = None,
) -> bool:
    """Whether ``new`` differs from ``old``; without an old table it always does.

    Mode ``total`` compares one sum and so misses an insert offset by a delete; it can take the new sum from the
    counts before they are joined. Mode ``fingerprint`` sees every changed value.
    """
    if mode not in MODES:
        raise ValueError(f"unknown gate mode {mode!r}")
    if old is None:
        return True
    if mode == "total":
        return (total_of(new, total) if new_total is None else new_total) != total_of(old, total)
    if set(new.columns) != set(old.columns):
        return True
    return fingerprint(new, total, ignore).first() != fingerprint(old, total, ignore).first()
